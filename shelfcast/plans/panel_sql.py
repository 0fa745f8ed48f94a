"""The same panel as SQL, for checking results with an independent engine."""

from __future__ import annotations

EPOCH = "DATE '1994-12-31'"

_ITEM = {"part": "p_type || '_' || CAST(p_partkey AS VARCHAR)", "brand": "p_type || '_' || p_brand"}


def panel(grain: str = "part") -> str:
    """``WITH`` list (without the keyword) defining the panel's relations."""
    return f"""
sales AS (
  SELECT item_id || '_' || store_id AS id, item_id, dept_id,
         CASE WHEN dept_id IN ('ECONOMY','PROMO') THEN 'VALUE'
              WHEN dept_id IN ('MEDIUM','SMALL') THEN 'REGULAR' ELSE 'BULK' END AS cat_id,
         store_id,
         CASE WHEN store_id IN ('AFRICA','ASIA') THEN 'A' ELSE 'B' END AS state_id,
         d, sales, cents
  FROM (
    SELECT {_ITEM[grain]} AS item_id, p_type AS dept_id, r_name AS store_id,
           CAST(CAST(l_shipdate AS DATE) - {EPOCH} AS INTEGER) AS d,
           sum(l_quantity) AS sales, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM lineitem
    JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    GROUP BY ALL)),
bounds AS (SELECT max(d) AS d1, max(d) - 28 AS t FROM sales),
ids AS (SELECT DISTINCT id, item_id, dept_id, cat_id, store_id, state_id FROM sales),
days AS (SELECT CAST(i AS INTEGER) AS d, {EPOCH} + CAST(i AS INTEGER) AS date
         FROM (SELECT unnest(generate_series(1, (SELECT d1 FROM bounds))) AS i)),
cal AS (
  SELECT d, date, CAST(floor(d / 7) AS INTEGER) AS wm_yr_wk, dayname(date) AS weekday,
         CAST(isodow(date) AS INTEGER) AS wday, CAST(month(date) AS INTEGER) AS month, CAST(year(date) AS INTEGER) AS year,
         CASE strftime(date, '%m-%d') WHEN '01-01' THEN 'NewYear' WHEN '02-14' THEN 'Valentines'
              WHEN '07-04' THEN 'Independence' WHEN '11-11' THEN 'Veterans' WHEN '12-25' THEN 'Christmas' END AS event_name_1,
         CASE strftime(date, '%m-%d') WHEN '01-01' THEN 'National' WHEN '02-14' THEN 'Cultural'
              WHEN '07-04' THEN 'National' WHEN '11-11' THEN 'National' WHEN '12-25' THEN 'Religious' END AS event_type_1,
         CASE strftime(date, '%m-%d') WHEN '12-25' THEN 'WinterSale' END AS event_name_2,
         CASE strftime(date, '%m-%d') WHEN '12-25' THEN 'Cultural' END AS event_type_2,
         CAST(day(date) % 2 AS INTEGER) AS snap_A,
         CAST(day(date) % 3 = 0 AS INTEGER) AS snap_B
  FROM days),
prices AS (
  SELECT store_id, item_id, CAST(floor(d / 7) AS INTEGER) AS wm_yr_wk, floor(sum(cents) / sum(sales)) / 100 AS sell_price
  FROM sales WHERE d <= (SELECT t FROM bounds) GROUP BY ALL),
steps AS (SELECT CAST(unnest(generate_series(1, 28)) AS INTEGER) AS h),
priced AS (
  SELECT store_id, item_id, d, sell_price
  FROM (SELECT *, CAST(unnest(generate_series(wm_yr_wk * 7, wm_yr_wk * 7 + 6)) AS INTEGER) AS d FROM prices)
  WHERE d BETWEEN 1 AND (SELECT t FROM bounds)
  UNION ALL
  SELECT store_id, item_id, t + h, sell_price
  FROM (SELECT store_id, item_id, arg_max(sell_price, wm_yr_wk) AS sell_price FROM prices GROUP BY ALL)
  CROSS JOIN steps CROSS JOIN bounds),
dense AS (
  SELECT i.*, c.d, coalesce(s.sales, 0.0) AS sales
  FROM ids i CROSS JOIN days c LEFT JOIN sales s ON s.id = i.id AND s.d = c.d),
masked AS (SELECT * REPLACE (CASE WHEN d <= (SELECT t FROM bounds) THEN sales END AS sales) FROM dense),
dept AS (
  SELECT g.store_id, g.dept_id, c.d, coalesce(s.sales, 0.0) AS sales
  FROM (SELECT DISTINCT store_id, dept_id FROM sales) g CROSS JOIN days c
  LEFT JOIN (SELECT store_id, dept_id, d, sum(sales) AS sales FROM sales GROUP BY ALL) s
    ON s.store_id = g.store_id AND s.dept_id = g.dept_id AND s.d = c.d),
rates AS (
  SELECT dept_id, store_id, avg(change) + 1 AS rate
  FROM (SELECT *, (sales - before) / nullif(before, 0) AS change
        FROM (SELECT *, lag(sales, 28) OVER (PARTITION BY dept_id, store_id ORDER BY d) AS before
              FROM dept WHERE d <= (SELECT t FROM bounds)))
  WHERE d > (SELECT t FROM bounds) - 365 AND abs(change) < 1
  GROUP BY ALL),
grid AS (
  SELECT i.*, p.d, CASE WHEN p.d <= (SELECT t FROM bounds) THEN coalesce(s.sales, 0.0) END AS sales,
         c.* EXCLUDE (d), p.sell_price, r.rate
  FROM priced p JOIN ids i ON i.store_id = p.store_id AND i.item_id = p.item_id
  JOIN cal c ON c.d = p.d
  LEFT JOIN sales s ON s.id = i.id AND s.d = p.d
  LEFT JOIN rates r ON r.dept_id = i.dept_id AND r.store_id = i.store_id),
tails AS (SELECT id, sum(sales) / 28 AS mean28 FROM sales
          WHERE d BETWEEN (SELECT t - 27 FROM bounds) AND (SELECT t FROM bounds) GROUP BY id),
base AS (
  SELECT i.*, h, coalesce(a.sales, 0.0) AS truth, coalesce(b.sales, 0.0) AS snaive7,
         coalesce(c.sales, 0.0) AS snaive28, coalesce(m.mean28, 0.0) AS mean28
  FROM ids i CROSS JOIN steps CROSS JOIN bounds
  LEFT JOIN sales a ON a.id = i.id AND a.d = t + h
  LEFT JOIN sales b ON b.id = i.id AND b.d = t - 6 + (h - 1) % 7
  LEFT JOIN sales c ON c.id = i.id AND c.d = t - 28 + h
  LEFT JOIN tails m ON m.id = i.id)
"""


def with_panel(grain: str, *more: str) -> str:
    """``WITH`` clause of the panel and further relations."""
    return "WITH " + ",\n".join([panel(grain).strip(), *[m.strip() for m in more]]) + "\n"

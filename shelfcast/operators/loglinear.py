"""Shares of items within a group as a softmax over all items, fitted without a column or a class per item.

The score of an item is a sum of one weight per margin, here ``(item, store)``,
``(item, weekday)`` and ``(item, quarter)``; a context (store, weekday and quarter
within a department) normalises the scores of its items.  This is the multinomial
logit, and equally a log-linear table of counts, so proportional fitting finds its
maximum: scale the cells of each item until its margins are the observed ones,
scale the contexts back to their totals, and repeat.  Items meet only in the totals
of contexts, which are aggregated map-side; everything else happens within an item,
whose cells are one row of the stored table.

Cells are long rows, one per sold pair of item and store and per context of it:
their number grows with the pairs, not with items times stores, nor with the days.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F, types as T

from shelfcast.functions.numeric import ratio
from shelfcast.session import measured

# Pseudo-sales, as a share of what a pair of item and store sold, spread evenly over its contexts.
PRIOR = 0.1


def share_cells(
    sales: DataFrame, within: Sequence[str], pair: Sequence[str], attributes: DataFrame, value: str = "sales",
    prior: float = PRIOR,
) -> DataFrame:
    """``within, pair, attributes, seen``: a cell for every context of every pair that sold.

    ``attributes`` lists the combinations of a day's attributes, a few dozen;
    ``sales`` carries the same columns.  The prior keeps every margin above 0, so
    that no weight is infinite; margins of a pair are ``1 + prior`` times its sales.
    """
    names, keys = attributes.columns, list(dict.fromkeys([*within, *pair]))
    sold = sales.groupBy(*keys, *names).agg(F.sum(value).alias("_sold")).filter(F.col("_sold") > 0)
    combos = [tuple(r) for r in attributes.distinct().orderBy(*names).collect()]
    types = [attributes.schema[n].dataType for n in names]
    listed = F.array(*[
        F.struct(*[F.lit(v).cast(t).alias(n) for v, t, n in zip(c, types, names)]) for c in combos
    ])
    own = F.array_position(listed, F.struct(*[F.col(n).cast(t).alias(n) for n, t in zip(names, types)])).cast("int")
    # a pair has at most as many rows here as there are combinations
    pairs = sold.groupBy(*keys).agg(
        F.sum("_sold").alias("_total"), F.map_from_entries(F.collect_list(F.when(own > 0, F.struct(own, F.col("_sold"))))).alias("_by_context"),
    )
    seen = F.coalesce(F.try_element_at("_by_context", F.col("_c")), F.lit(0.0)) + F.col("_total") * F.lit(prior / len(combos))
    cells = pairs.withColumn("_c", F.explode(F.sequence(F.lit(1), F.lit(len(combos)))))
    return cells.withColumn("_o", F.get(listed, F.col("_c") - 1)).select(*keys, *[F.col(f"_o.{n}").alias(n) for n in names], seen.alias("seen"))


def fit_shares(
    cells: DataFrame, item: str, within: Sequence[str], margins: Sequence[Sequence[str]], context: Sequence[str],
    cycles: int = 12,
) -> DataFrame:
    """The cells with ``share``, the fitted share of the item in its context; shares of a context add up to 1.

    ``margins`` are key lists beside the item; ``context`` are the keys beside
    ``within``.  The cells are written once, one row per item.  Nothing else is kept
    of a fit: it follows from the item's own cells and the factors of the contexts so
    far, so a cycle is one pass that repeats the earlier ones in memory and shuffles
    only the totals of the contexts.  The driver holds one number per context and cycle.
    """
    contexts = [*within, *context]
    names = list(dict.fromkeys([*contexts, *itertools.chain(*margins)]))
    points = cells.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"), F.sum("seen").alias("_s")).dropna(subset=contexts)
    # one row for each combination of keys of departments, stores and days, whatever the number of items and sales
    found = points.orderBy(*names).collect()
    place, groups = _codes(found, contexts), [_codes(found, keys) for keys in margins]
    seen_in = np.bincount(place, [r["_s"] for r in found])
    listed = cells.sparkSession.createDataFrame(
        [(*[r[c] for c in names], k) for k, r in enumerate(found)],
        T.StructType([*[cells.schema[c] for c in names], T.StructField("_point", T.IntegerType())]),
    )
    same = [F.col(f"_p_{c}").eqNullSafe(F.col(c)) for c in names]
    coded = cells.join(F.broadcast(listed.select("_point", *[F.col(c).alias(f"_p_{c}") for c in names])), same)
    rest = [c for c in cells.columns if c not in [item, *names]]
    items = measured(
        coded.groupBy(item).agg(F.collect_list(F.struct("_point", *rest)).alias("_cells"))
        .select(item, "_cells", F.col("_cells._point").alias("_points"), F.col("_cells.seen").cast("array<double>").alias("_seen"))
    )
    sums, factors = np.bincount(place, [r["_n"] for r in found]), []
    for _ in range(cycles):
        factors.append(_ratio(seen_in, sums))
        sums = _context_sums(items, place, groups, factors)
    last = _ratio(seen_in, sums)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def fit_of(points: pa.Array, seen: pa.Array) -> pa.Array:
        fit = _item_fits(points, seen, place, groups, factors) * last[place[points.flatten().to_numpy()]]
        return pa.ListArray.from_arrays(_offsets(points), pa.array(fit))

    zipped = F.explode(F.arrays_zip("_cells", fit_of("_points", "_seen").alias("_fit")))
    rows = items.select(F.col(item), zipped.alias("_cell")).select(
        item, F.col("_cell._cells._point").alias("_point"), *[F.col(f"_cell._cells.{c}").alias(c) for c in rest],
        F.col("_cell._fit").alias("fit"),
    )
    totals = listed.sparkSession.createDataFrame(
        [(k, float(seen_in[p])) for k, p in enumerate(place)], "_point int, _context_seen double")
    keys = listed.select(*[F.col(c) for c in names if c != item], "_point").join(totals, "_point")
    named = rows.join(F.broadcast(keys), "_point")
    return named.select(*cells.columns, "fit", ratio(F.col("fit"), F.col("_context_seen")).alias("share"))


def _codes(rows: Sequence[Row], keys: Sequence[str]) -> np.ndarray:
    """A number for each row, equal where ``keys`` are."""
    numbers: dict[tuple, int] = {}
    return np.array([numbers.setdefault(tuple(r[k] for k in keys), len(numbers)) for r in rows], dtype=np.int64)


def _ratio(above: np.ndarray, below: np.ndarray) -> np.ndarray:
    return np.divide(above, below, out=np.zeros(len(above)), where=below > 0)


def _offsets(lists: pa.ListArray) -> pa.Array:
    """Offsets from 0: an array may be a slice of a longer one."""
    return pa.array(lists.offsets.to_numpy() - lists.offsets[0].as_py(), pa.int32())


def _item_fits(
    points: pa.ListArray, seen: pa.ListArray, place: np.ndarray, groups: Sequence[np.ndarray], factors: Sequence[np.ndarray]
) -> np.ndarray:
    """The cells' fit after one cycle per element of ``factors``, for a batch of items."""
    sizes = np.diff(_offsets(points).to_numpy())
    row, point = np.repeat(np.arange(len(sizes)), sizes), points.flatten().to_numpy()
    known, at = seen.flatten().to_numpy(), place[point]
    margins = []
    for group in groups:
        width = int(group.max()) + 1 if len(group) else 1
        cell = row * width + group[point]
        if len(sizes) * width > 4 * len(cell) + 1024:
            cell = np.unique(cell, return_inverse=True)[1]
        margins.append((cell, np.bincount(cell, known)))
    fit = np.ones(len(point))
    for factor in factors:
        fit *= factor[at]
        for cell, goal in margins:
            fit *= _ratio(goal, np.bincount(cell, fit))[cell]
    return fit


def _context_sums(items: DataFrame, place: np.ndarray, groups: Sequence[np.ndarray], factors: Sequence[np.ndarray]) -> np.ndarray:
    """Fitted totals of the contexts after one cycle per element of ``factors``; added up in the tasks, then over them."""
    n, factors = int(place.max()) + 1 if len(place) else 0, list(factors)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(n)
        for b in batches:
            fit = _item_fits(b.column(0), b.column(1), place, groups, factors)
            sums += np.bincount(place[b.column(0).flatten().to_numpy()], fit, minlength=n)
        yield pa.record_batch({"context": pa.array(np.arange(n)), "fit": pa.array(sums)})

    rows = items.select("_points", "_seen").mapInArrow(totals, "context long, fit double")
    sums = np.zeros(n)
    for r in rows.groupBy("context").agg(F.sum("fit").alias("fit")).collect():
        sums[r["context"]] = r["fit"]
    return sums


def margin_gap(fitted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Observed and fitted totals per ``keys``; equal for every margin of a fit that has converged."""
    return fitted.groupBy(*keys).agg(F.sum("seen").alias("seen"), F.sum("fit").alias("fit"))

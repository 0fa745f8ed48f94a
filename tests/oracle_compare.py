"""Runs registered queries beside their SQL and compares the rows.

``python tests/oracle_compare.py [sf_dir] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _normal(table) -> pd.DataFrame:
    """Columns by name; numbers as rounded doubles, everything else as text."""
    out = {}
    for name in sorted(table.column_names):
        column = table.column(name)
        kind = column.type
        if pa.types.is_boolean(kind) or pa.types.is_integer(kind) or pa.types.is_floating(kind) or pa.types.is_decimal(kind):
            values = column.cast(pa.float64(), safe=False).to_pandas().astype(float)
            out[name] = values.round(9) + 0.0
        else:
            out[name] = column.cast(pa.string()).to_pandas().fillna("<null>").astype(object)
    return pd.DataFrame(out)


def compare(df, con, sql):
    """None when equal, else a description of the first difference; and the number of rows."""
    mine = _normal(df.toArrow())
    theirs = _normal(con.sql(sql).to_arrow_table())
    if list(mine.columns) != list(theirs.columns):
        return f"columns {list(mine.columns)} vs {list(theirs.columns)}", len(mine)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows vs {len(theirs)}", len(mine)
    a = pd.util.hash_pandas_object(mine, index=False)
    b = pd.util.hash_pandas_object(theirs, index=False)
    if (np.sort(a.to_numpy()) == np.sort(b.to_numpy())).all():
        return None, len(mine)
    only_a, only_b = mine[~a.isin(b)], theirs[~b.isin(a)]
    first = [x.sort_values(list(x.columns)).head(1).to_dict("records") for x in (only_a, only_b)]
    return f"{len(only_a)} of {len(mine)} rows differ: {first[0]} vs {first[1]}", len(mine)


def main() -> int:
    from shelfcast.session import local_session

    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    queries, oracle = entry.queries(), entry.oracle_sql()
    spark, con = local_session(), connect(sf_dir)
    failed = []
    for name in args[1:] or list(queries):
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracle:
                problem, n = compare(df, con, oracle[name])
            else:
                problem, n = None, df.toArrow().num_rows
        except Exception as error:  # report and go on with the next query
            problem, n = f"{type(error).__name__}: {str(error)[:600]}", 0
        status = "ok  " if problem is None else "FAIL"
        print(f"{status} {name:24s} {'sql ' if name in oracle else 'rows'} {n:8d} rows {time.time() - start:6.1f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())

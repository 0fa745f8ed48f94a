"""Every query with SQL gives the same rows as that SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle_compare import compare, connect


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, small, con, name):
    problem, _ = compare(entry.queries()[name](spark, small), con, entry.oracle_sql()[name])
    assert problem is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


UNCHECKED = sorted(set(entry.queries()) - set(entry.oracle_sql()) - {"pipeline"})


@pytest.mark.parametrize("name", [n for n in UNCHECKED if not n.startswith("op")])
def test_query_without_sql_gives_finite_rows(spark, small, name):
    rows = entry.queries()[name](spark, small).toPandas()
    assert len(rows)
    numbers = rows.select_dtypes("number").drop(columns=["rmsse"], errors="ignore")
    assert numbers.notna().all().all()

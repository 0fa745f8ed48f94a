"""A panel kept as a table: bucketed and sorted by series, partitioned by blocks of weeks, appended to week by week.

All rows of a series lie in one bucket, so windows over series, and joins of two
tables with as many buckets, need no shuffle.  New days rewrite the blocks that
they fall in and the horizon's block, and leave all earlier blocks as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.session import measured, scratch_path

# The block of the days that are to be forecast; history has 0, 1, ...
HORIZON_BLOCK = -1
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@dataclass(frozen=True)
class PanelStore:
    """The table ``name``: a row per series and day, ``key`` names the series, ``d`` the day.

    ``buckets`` should follow the number of rows, since a task sorts the rows of a
    bucket: files of the largest block should not pass 128 MB;
    ``weeks`` is the length of a block, which is what an append rewrites.  The
    table's ``block`` column is added by the store.
    """

    spark: SparkSession
    name: str
    buckets: int = 8
    weeks: int = 13
    key: str = "id"

    def first_day(self, day: int) -> int:
        """The first day of the block that ``day`` falls in; blocks begin with a pricing week."""
        return day // (7 * self.weeks) * 7 * self.weeks

    def with_block(self, rows: DataFrame, train_last: int) -> DataFrame:
        block = F.floor(F.col("d") / (7 * self.weeks)).cast("int")
        return rows.withColumn("block", F.when(F.col("d") > train_last, F.lit(HORIZON_BLOCK)).otherwise(block))

    def dealt(self, rows: DataFrame) -> DataFrame:
        """Dealt as the buckets are, so that each task writes one file per block; rows that are so already stay in place."""
        return rows.repartition(self.buckets, self.key)

    def create(self, rows: DataFrame, train_last: int, path: str) -> None:
        """Write the whole panel; days after ``train_last`` are the horizon."""
        (
            self.dealt(self.with_block(rows, train_last)).write.format("parquet").partitionBy("block")
            .bucketBy(self.buckets, self.key).sortBy(self.key, "d").option("path", path).saveAsTable(self.name)
        )

    def read(self) -> DataFrame:
        """All rows, without the store's own column."""
        return self.spark.table(self.name).drop("block")

    def horizon(self) -> DataFrame:
        return self.spark.table(self.name).filter(F.col("block") == HORIZON_BLOCK).drop("block")

    def files(self, path: str) -> DataFrame:
        """The rows of :meth:`read`, from the files at the store's ``path``: they can be read on after the table is forgotten."""
        return self.spark.read.schema(self.spark.table(self.name).schema).parquet(path).drop("block")

    def replace(self, *parts: DataFrame, train_last: int) -> None:
        """Write the blocks that the rows of ``parts`` fall in anew; the others stay.

        The rows must not come from the blocks that are replaced.  Each part is
        dealt on its own, so that one that lies so already is not moved.
        """
        columns = self.spark.table(self.name).columns
        own = [self.dealt(self.with_block(p, train_last).select(*columns)) for p in parts]
        before = self.spark.conf.get(OVERWRITE_MODE)
        self.spark.conf.set(OVERWRITE_MODE, "dynamic")
        try:
            reduce(DataFrame.unionByName, own).write.mode("overwrite").insertInto(self.name)
        finally:
            self.spark.conf.set(OVERWRITE_MODE, before)

    def append(
        self, rows_since: Callable[[int], DataFrame], known_last: int, train_last: int, last: int,
        series: Sequence[str], carried: str = "sell_price",
    ) -> None:
        """Take in the days after ``known_last`` up to ``train_last``, and move the horizon to end at ``last``.

        ``rows_since(day)`` makes the panel's rows, horizon included, from the
        sources' days from ``day`` on.  Series without a row there have no new
        days; their horizon is moved with the last known ``carried`` value.  Both
        are stored first, those series a row each: they come from a block that is
        replaced, and a repeated attempt then finds them unchanged.
        """
        fresh = measured(rows_since(self.first_day(known_last + 1)))
        quiet = measured(self.horizon().groupBy(*series).agg(F.max(carried).alias(carried)).join(
            fresh.select(self.key).distinct(), self.key, "left_anti"))
        # dealt before they get their days
        moved = self.dealt(quiet).withColumn("d", F.explode(F.sequence(F.lit(train_last + 1), F.lit(last)))).withColumns(
            {f.name: F.lit(None).cast(f.dataType) for f in fresh.schema if f.name not in (*quiet.columns, "d")})
        self.replace(fresh, moved, train_last=train_last)

    def drop(self) -> None:
        """Forget the table; its files belong to whoever gave the path."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


@contextmanager
def temporary_store(spark: SparkSession, **options) -> Iterator[tuple[PanelStore, str]]:
    """A store under a name of its own, with a path in the shared folder; forgotten at the end, also after a failure."""
    store = PanelStore(spark, f"panel_{uuid.uuid4().hex}", **options)
    try:
        yield store, scratch_path(spark, "panel")
    finally:
        store.drop()

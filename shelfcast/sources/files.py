"""CSV and Parquet readers and writers.

Readers take explicit schemas (a CSV is never read twice to infer types) and
leave column pruning and filter push-down to the scan.  Writers emit a folder
of part files; nothing is funnelled into one file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfcast.sources.schemas import wide_sales


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    columns: Sequence[str] | None = None,
    date_format: str = "yyyy-MM-dd",
) -> DataFrame:
    """Typed CSV scan; empty cells and ``NaN`` become NULL."""
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("dateFormat", date_format)
        .option("nanValue", "")
        .csv(path)
    )
    return nan_to_null(df if columns is None else df.select(*columns))


def read_wide(spark: SparkSession, path: str, last: int) -> DataFrame:
    """A sales file with one column per day and no header.

    Thousands of columns: missing values are left to whoever melts them.
    """
    return spark.read.schema(wide_sales(last)).csv(path)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing values are NULL throughout the library, never NaN."""
    fixed = [
        F.nullif(F.col(f.name), F.lit(float("nan")).cast(f.dataType)).alias(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType))
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*fixed)


def read_csv_glob(spark: SparkSession, pattern: str, schema: T.StructType) -> DataFrame:
    """All files matching a glob in one scan, with the name of the file or folder each row is from."""
    raw = (
        spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).csv(pattern)
    )
    path = F.col("_metadata.file_path")
    return raw.select(*[f.name for f in schema.fields], path.alias("file_path"))


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (), compression: str | None = None) -> str:
    """CSV with a header and no index column; readers know a ``compression`` by the ending of the files.

    A compressed file is read by one task, as a stream.
    """
    df.write.partitionBy(*partition_by).option("header", True).csv(path, compression=compression)
    return path


def write_lines(lines: DataFrame, path: str) -> str:
    """Ready-made text lines, without a header."""
    lines.write.text(path)
    return path


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Parquet keeps every type, so it also stands in for pickled frames.

    Rows are clustered by the partition columns before the write: a task then
    writes few partitions instead of a sliver of each.  AQE splits oversized
    partitions of that shuffle, so one hot store is still written by many tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.partitionBy(*partition_by).parquet(path)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_forecasts(df: DataFrame, path: str) -> str:
    """One dataset for all models and horizons instead of a file per pair."""
    return write_table(df, path, ["model", "horizon"])

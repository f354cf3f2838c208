"""File tables: projected scans, chunk scans and idempotent sinks."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tallyport.runtime import default_partitions

_LISTERS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def scan(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, where: Column | str | None = None
) -> DataFrame:
    """Scan of explicit columns; ``where`` goes down to the files."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def scan_key_range(df: DataFrame, key: str, low, high) -> DataFrame:
    """Rows whose key lies in the range, both ends included."""
    return df.where(F.col(key).between(low, high))


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_rows(df: DataFrame, path: str) -> None:
    """Truncate, then load."""
    df.write.mode("overwrite").parquet(path)


def replace_partitions(df: DataFrame, path: str, partition: str) -> int:
    """Overwrite only the partitions that ``df`` holds, so that a rerun of some chunks
    leaves the others alone and never doubles rows.

    The rebalance hint brings the rows of a partition together without a small file per
    task, and lets AQE split a partition that holds far more rows than the rest.

    Returns the rows that the write itself has seen, counted behind the last shuffle.
    """
    seen = Observation()
    (
        df.hint("rebalance", F.col(partition))
        .observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    return seen.get["rows"]


@contextmanager
def few_listers(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by a few tasks for each shuffle partition, not by one task for each
    folder; the listing belongs to the making of a frame."""
    before = spark.conf.get(_LISTERS)
    spark.conf.set(_LISTERS, str(min(int(before), 4 * default_partitions(spark))))
    try:
        yield
    finally:
        spark.conf.set(_LISTERS, before)


def read_partitions(
    spark: SparkSession, path: str, schema: T.StructType, partition: str, values: Sequence[int]
) -> DataFrame:
    """The rows of some partitions; the folders of others are not listed.

    The driver names each folder once, as the listing does.  If one is not there, all
    are listed and other partitions than ``values`` are filtered out by the caller.
    """
    folders = [f"{path}/{partition}={value}" for value in values]
    with few_listers(spark):
        try:
            return spark.read.schema(schema).option("basePath", path).parquet(*folders)
        except AnalysisException:
            return spark.read.schema(schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def remove_rows(spark: SparkSession, path: str) -> None:
    """Truncate a file table; a missing one is left alone."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


def require_empty(spark: SparkSession, path: str) -> None:
    """Raise if the target holds any row; a missing target counts as empty."""
    if not path_exists(spark, path):
        return
    existing = spark.read.parquet(path)
    if not existing.limit(1).isEmpty():
        raise ValueError(f"target {path} contains {existing.count()} rows")


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: name, rows, and whether it is empty."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", (F.col("row_count") == 0).alias("is_empty")
        )
        counts = one if counts is None else counts.unionByName(one)
    if counts is None:
        raise ValueError("no tables given")
    return counts

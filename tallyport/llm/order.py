"""A total order of all rows without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyport.operators.chunks import has_row_positions, is_file_scan
from tallyport.runtime import default_partitions, settle_table

_INDEX = (1 << 33) - 1


def numbered(df: DataFrame, by: list[Column], position: str = "pos") -> DataFrame:
    """Add the place of each row in the order of ``by`` as a long from 0.

    Rows are range partitioned, sorted and written once to the shared folder.  A row's
    place is its place in its partition plus the rows of the partitions before, a table of
    one row per partition.  Let ``by`` end in columns that tell rows apart: then a value
    that a third of the rows share is spread over many partitions.  ``df`` should be a
    written table, since ranges are chosen from a first pass over it.
    """
    parts = default_partitions(df.sparkSession)
    ordered = df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    table = settle_table(ordered.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    table = table.withColumn("_part", F.shiftright("_at", 33))
    sizes = table.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_at").bitwiseAND(F.lit(_INDEX))
    # One row per partition of the order, as many as spark.sql.shuffle.partitions.
    return table.join(F.broadcast(starts), "_part").withColumn(position, place).drop("_part", "_at", "_start")


#: Rows of a few numbers that are sent to all executors; more are joined by a shuffle.
SENT = 2_000_000


def side(df: DataFrame) -> DataFrame:
    """``df``, written once, as the small side of a join: sent to all executors if it has at
    most ``SENT`` rows, else left to a shuffle.  The rows of the join are the same."""
    held = settle_table(df, "side")
    return F.broadcast(held) if held.count() <= SENT else held


#: Rows of one file have numbers from a multiple of ``1 << FILE_BITS`` on.
FILE_BITS = 33


def with_rows(docs: DataFrame) -> DataFrame:
    """``row``, a number of each row, and ``doc``, a struct of all columns.

    A row is known by its file, in the order of paths, and its place in the file, so all plans
    over the same files give the same numbers, however the files are split.  Frames that are not
    a plain scan of files are written to the shared folder first.
    """
    if not (is_file_scan(docs) and has_row_positions(docs)):
        docs = settle_table(docs, "rows")
    path, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    doc = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")
    # One row per file; the driver lists the files anyway.
    files = docs.select(path.alias("file")).distinct()
    files = files.select("file", (F.row_number().over(Window.orderBy("file")) - 1).cast("long").alias("number"))
    placed = docs.select(path.alias("file"), place.alias("place"), doc).join(side(files), "file")
    return placed.select((F.shiftleft("number", FILE_BITS) + F.col("place")).alias("row"), "doc")

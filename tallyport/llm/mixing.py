"""Mixing sources to target weights by systematic sampling.

Sizes are counted once from the whole texts and written as a narrow table.  Targets are
shares of the whole by weight, stopped at ``most`` times a source's size.  Within a source,
documents stand in the order of their size, a running sum of expected copies goes over
them, and a document is taken once for each whole number that its stretch of the sum
crosses.  Neighbours in that order have nearly equal sizes, so the words taken come close
to the target.  Expected copies are whole multiples of 2**-24, so that sums are exact and
no document is taken more often than its expected copies rounded up.

Defined cases: a null text has size 0; a null source is a source of its own, ordered
last; a source of size 0 gets target 0; repeated rows and repeated ids are separate
documents; an empty table gives an empty result.  Columns of the input may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyport.llm.order import side, with_rows
from tallyport.llm.words import BLANK_WORDS, find_words, pieces, text_bytes
from tallyport.runtime import default_partitions, settle, settle_table

SCALE = 1 << 24
WEIGHTS = (5, 2, 1)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        data, offsets = text_bytes(batch.column("text"))
        counts = find_words(data, offsets, BLANK_WORDS, hashed=False).counts
        names = [n for n in batch.schema.names if n != "text"]
        columns = [batch.column(n) for n in names] + [pa.array(counts.astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, names=[*names, "size"])


def sizes(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """``row`` (a number of the row), ``doc_id``, ``source`` and ``size`` in words."""
    narrow = docs.select(
        (F.monotonically_increasing_id() if row is None else row).alias("row"),
        F.col("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("text").cast("string").alias("text"),
    )
    kind = f"row long, doc_id {narrow.schema['doc_id'].dataType.simpleString()}, source string, size long"
    return narrow.mapInArrow(_count_words, kind)


def targets(measured: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``.

    The excess over a limit is shared among the others by weight, again and again, until no
    target is above its limit.  The table has a row per source; each round is one
    aggregation over it.
    """
    totals = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    totals = settle(totals)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    table = settle(totals.select("source", "source_size", weight.cast("double").alias("weight")))
    whole = float(table.agg(F.sum("source_size")).first()[0] or 0)
    limit = most * F.col("source_size")
    rate = 0.0
    while True:
        # A source is full once its share at the present rate reaches its limit.
        full = F.col("weight") * rate >= limit
        used, free = table.agg(
            F.sum(F.when(full, limit).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        if not free:
            break
        following = (whole - float(used)) / free
        if following <= rate:
            break
        rate = following
    share = F.least(F.col("weight") * rate, limit.cast("double"))
    return table.select("source", "source_size", share.alias("target"))


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running sums of ``step`` within runs of equal ``source`` of one partition."""
    known, total = object(), 0
    for batch in batches:
        if not batch.num_rows:
            continue
        source = batch.column("source")
        steps = batch.column("step").to_numpy(zero_copy_only=False).astype(np.int64)
        codes = source.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        sums = np.cumsum(steps)
        begins = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        base = np.where(begins > 0, sums[begins - 1], 0)
        base[0] = -total if source[0].as_py() == known else 0
        ends = np.concatenate([begins[1:], [len(sums)]])
        sums = sums - np.repeat(base, ends - begins)
        known, total = source[len(source) - 1].as_py(), int(sums[-1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(sums)], names=[*batch.schema.names, "reached"]
        )


def systematic(df: DataFrame, expected: Column, seed: int = 0, offsets: int = 32) -> DataFrame:
    """Add ``copies`` to rows with ``row``, ``doc_id``, ``source``, ``size`` and ``target``.

    ``expected`` is the number of copies a row should have on average.  The order within a
    source is by size, then by a hash of ``doc_id``.  Each source draws ``offsets`` random
    offsets from a hash of its name and keeps the one whose words come nearest to its target:
    where a few long documents make up a source, one draw alone can miss it by their size.
    """
    steps = F.round(expected * SCALE).cast("long").alias("step")
    mark = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string")).alias("mark")
    ready = df.select("*", steps, mark)
    by = [F.col("source").asc_nulls_last(), F.col("size"), F.col("mark"), F.col("doc_id"), F.col("row")]
    ordered = ready.repartitionByRange(default_partitions(df.sparkSession), *by).sortWithinPartitions(*by)
    ordered = ordered.select("*", F.spark_partition_id().cast("long").alias("part"))
    kinds = ", ".join(f"`{n}` {t}" for n, t in ordered.dtypes)
    table = settle_table(ordered.mapInArrow(_running, f"{kinds}, reached long"), "running")

    sums = table.groupBy("source", "part").agg(F.sum("step").alias("sum"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("s_source"),
        F.col("part").alias("s_part"),
        F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("start"),
    )
    same = table["source"].eqNullSafe(starts["s_source"]) & (table["part"] == starts["s_part"])
    rows = table.join(starts, same).drop("s_source", "s_part")

    def offset(draw: Column | int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed + 1), F.coalesce("source", F.lit("\0")), F.lit(draw)), F.lit(SCALE))

    def crossed(draw: Column | int) -> Column:
        end = F.col("start") + F.col("reached") + offset(draw)
        return F.shiftright(end, 24) - F.shiftright(end - F.col("step"), 24)

    misses = [
        F.struct(F.abs(F.sum(crossed(i) * F.col("size")) - F.first("target")).alias("miss"), F.lit(i).alias("draw"))
        for i in range(offsets)
    ]
    best = rows.groupBy("source").agg(F.least(*misses)["draw"].alias("draw"))
    best = settle(best.select(F.col("source").alias("b_source"), "draw"))
    chosen = rows.join(best, rows["source"].eqNullSafe(best["b_source"]))
    return chosen.select(*df.columns, crossed(F.col("draw")).alias("copies"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3, seed: int = 0, row: Column | None = None
) -> DataFrame:
    """One row per document: ``row, doc_id, source, size, source_size, target, copies``."""
    measured = settle_table(sizes(docs, row), "sizes")
    wanted = targets(measured, weights, most)
    goal = wanted.select(F.col("source").alias("t_source"), "source_size", "target")
    rows = measured.join(goal, measured["source"].eqNullSafe(goal["t_source"])).drop("t_source")
    share = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most))))
    return systematic(rows, F.coalesce(share, F.lit(0.0)), seed)


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3, seed: int = 0) -> DataFrame:
    """The documents of the mix with all columns of the input, each once per copy."""
    whole = with_rows(docs)
    plain = whole.select("row", "doc.doc_id", "doc.source", "doc.text")
    chosen = mix(plain, weights, most, seed, F.col("row")).where("copies > 0")
    copies = chosen.select("row", F.sequence(F.lit(1), F.col("copies").cast("int")).alias("copies"))
    rows = whole.join(side(copies), "row")
    return rows.select("doc", F.explode("copies").alias("copy")).select("doc.*")

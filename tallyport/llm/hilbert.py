"""Sharding along a Hilbert curve over document metadata, with DataFrame functions only.

Each dimension is cut into cells at its quantiles, so that a value with a third of all
rows takes one cell and the rest still spread.  The cells are points of a grid; their index on
the Hilbert curve orders the documents, and equal runs of that order are the shards.
Documents of a shard then lie close together in every dimension, and the ranges of a
shard's metadata (:func:`shard_bounds`) let a reader skip it.

Texts are read once, for their size and checksum; all that is shuffled are narrow rows.
Defined cases: nulls take the first cell of their dimension; a null text has size 8 and
the checksum of the empty text; repeated rows get places of their own; an empty table
gives an empty result.  Columns of the input may have any names.
"""

from __future__ import annotations

import os
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyport.llm.order import numbered, side, with_rows
from tallyport.runtime import settle, settle_table

BITS = 6
SHARDS = 24
DIMENSIONS = ("source", "lang", "size")


def _rotate_right(x: int, by: int, dims: int) -> int:
    by %= dims
    return (x >> by | x << (dims - by)) & ((1 << dims) - 1)


def curve_steps(dims: int) -> list[list[tuple[int, int]]]:
    """For each orientation of a cell, the step and the next orientation by corner.

    An orientation is an entry corner and a direction (``entry * dims + direction``).  The
    step of a corner is its place on the curve through the cell, the inverse Gray code of
    the corner seen from the entry.
    """
    whole = 1 << dims
    gray = [i ^ i >> 1 for i in range(whole)]
    place = {g: i for i, g in enumerate(gray)}

    def entry(w: int) -> int:
        return 0 if w == 0 else gray[(w - 1) & ~1]

    def ones(w: int) -> int:
        return (~w & w + 1).bit_length() - 1  # trailing ones

    def direction(w: int) -> int:
        if w == 0:
            return 0
        return ones(w) % dims if w & 1 else ones(w - 1) % dims

    table = []
    for e in range(whole):
        for d in range(dims):
            row = []
            for corner in range(whole):
                w = place[_rotate_right(corner ^ e, d + 1, dims)]
                turned = _rotate_right(entry(w), dims - (d + 1) % dims, dims)
                row.append((w, (e ^ turned) * dims + (d + direction(w) + 1) % dims))
            table.append(row)
    return table


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """The index on the curve of a point with whole coordinates below ``2 ** bits``."""
    dims = len(cells)
    steps = curve_steps(dims)
    flat = [w << 16 | state for row in steps for w, state in row]
    table = F.array(*(F.lit(x).cast("long") for x in flat))

    def corner(level: Column) -> Column:
        out = F.lit(0).cast("long")
        for i, cell in enumerate(cells):
            bit = F.call_function("shiftright", cell, level).bitwiseAND(F.lit(1))
            out = out.bitwiseOR(F.shiftleft(bit.cast("long"), i))
        return out

    # One number carries the index so far (above 16 bits) and the orientation (below).
    def onward(carried: Column, level: Column) -> Column:
        state = carried.bitwiseAND(F.lit(0xFFFF))
        found = F.element_at(table, (state * (1 << dims) + corner(level) + 1).cast("int"))
        index = F.shiftright(carried, 16)
        step = F.shiftright(found, 16)
        return F.shiftleft(F.shiftleft(index, dims) + step, 16) + found.bitwiseAND(F.lit(0xFFFF))

    levels = F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1))
    return F.shiftright(F.aggregate(levels, F.lit(0).cast("long"), onward), 16)


def _as_number(df: DataFrame, name: str) -> Column:
    """A number that keeps the order of a column; of a text, eight bytes after the part
    that its smallest and largest value share."""
    if df.schema[name].dataType.simpleString() != "string":
        return F.col(name).cast("double")
    low, high = df.agg(F.min(name), F.max(name)).first()
    shared = len(os.path.commonprefix([(low or "").encode(), (high or "").encode()]))
    tail = F.substring(F.encode(F.col(name), "UTF-8"), shared + 1, 7)
    return F.conv(F.rpad(F.hex(tail), 14, "0"), 16, 10).cast("double")


def _below(number: Column, bound: Column) -> Column:
    return bound < number


def cells(df: DataFrame, dimensions: tuple[str, ...], bits: int = BITS) -> DataFrame:
    """Add a column ``cell_<name>`` for each dimension: the number of cuts below it.

    The cuts are ``2 ** bits - 1`` quantiles of the dimension over all rows.  A frequent
    value is several cuts at once, so the cell numbers after it jump by its share, and a
    dimension of few values still spans the whole side of the grid.
    """
    numbers = df.select("*", *(_as_number(df, n).alias(f"number_{n}") for n in dimensions))
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = numbers.agg(*(F.percentile_approx(f"number_{n}", shares, 10_000).alias(n) for n in dimensions)).first()
    out = numbers
    for n in dimensions:
        bounds = cuts[n] or []
        spread = F.lit(0)
        if bounds:
            number = F.col(f"number_{n}")
            below = F.size(F.filter(F.array(*map(F.lit, bounds)), partial(_below, number)))
            spread = F.when(number.isNull(), 0).otherwise(below)
        out = out.withColumn(f"cell_{n}", spread.cast("int"))
    return out.drop(*(f"number_{n}" for n in dimensions))


def place(docs: DataFrame, shards: int = SHARDS, bits: int = BITS, row: Column | None = None) -> DataFrame:
    """One row per document with its metadata, ``curve``, ``shard`` and ``slot``.

    Shards hold equal numbers of rows, at most one apart.  Rows at one point of the curve stand
    in the order of their metadata, checksum and id, so equal texts of a source are neighbours.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = docs.select(
        (F.monotonically_increasing_id() if row is None else row).alias("row"),
        F.col("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    table = settle_table(narrow, "metadata")
    points = cells(table, DIMENSIONS, bits)
    curve = hilbert_index([F.col(f"cell_{n}") for n in DIMENSIONS], bits)
    points = settle_table(points.withColumn("curve", curve), "points")
    by = [F.col(c) for c in ("curve", *DIMENSIONS, "text_crc32", "doc_id", "row")]
    ordered = numbered(points, by)
    rows = points.count()
    # Shard k begins at place ceil(k * rows / shards).
    shard = F.expr(f"pos * {shards} div {max(rows, 1)}")
    begin = F.expr(f"(shard * {rows} + {shards - 1}) div {shards}")
    return ordered.withColumn("shard", shard.cast("int")).withColumn("slot", (F.col("pos") - begin).cast("long"))


def shard_bounds(placed: DataFrame) -> DataFrame:
    """Per shard, rows, bytes and the range of each dimension: what a reader needs to
    skip shards."""
    ranges = [f(n).alias(f"{k}_{n}") for n in DIMENSIONS for k, f in (("min", F.min), ("max", F.max))]
    return placed.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), *ranges)


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Write the documents as one folder per shard, in the order of the curve, and return
    :func:`shard_bounds`."""
    whole = with_rows(docs)
    plain = whole.select("row", *(f"doc.{c}" for c in ("doc_id", "source", "lang", "text")))
    placed = place(plain, shards, bits, F.col("row"))
    placed = settle(placed.select("row", "shard", "slot", "size", *DIMENSIONS[:2]))
    rows = whole.join(side(placed.select("row", "shard", "slot")), "row")
    rows = rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    rows.select("shard", "slot", "doc").write.partitionBy("shard").parquet(path)
    return shard_bounds(placed)

"""Compressing vectors to codes: a codebook for each part of the vector, compared by exact
matrix products of limbs.

Components become whole numbers, ``floor(scale * x)``.  A vector is cut into equal parts and
each part gets the number of the nearest entry of its codebook, by squared distance.  Of
``|x - c|**2 = |x|**2 - 2 x.c + |c|**2`` only ``x.c`` costs much.  It is a float64 matrix
product (BLAS), made exact: whole numbers are broken into limbs so narrow that no sum of
products of two limbs reaches ``2**53``; the products of all pairs of limbs are shifted and
added in int64.  The smallest distance at the lowest index wins, as ``argmin`` has it.

Codebooks start as given vectors and are improved in rounds.  A round is one pass over the
vectors: each task adds up its parts by entry, so that it hands on one row per entry it used,
and the sums of all tasks are added on Spark.  Only codebooks reach the driver.

Defined cases: a vector that is null or holds a null or non-finite component is dropped;
shorter vectors count as extended by zeros to the longest, which is extended to a multiple of
the number of parts; equal ids are ordered by their components, a null id comes last; repeated
rows are separate vectors; with fewer vectors than entries, codebooks are shorter; no
vectors give no rows; numbers whose distances or sums cannot be a long raise
``OverflowError``; other columns, whatever their names, play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.llm.order import side
from tallyport.runtime import settle_table

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Rows that are compared at once.
ROWS = 2048
_EXACT = 1 << 53
_LONG = 1 << 63


def limb_bits(width: int) -> int:
    """The widest limb: ``width`` products of two of them stay below ``2**53``."""
    bits = 26
    while width << 2 * bits > _EXACT:
        bits -= 1
    return bits


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Whole numbers as float64 digits of ``bits`` bits, the lowest first; the last has the
    sign and is below ``2**bits`` as well."""
    rest, found = values, []
    while rest.size and max(int(rest.max()), -int(rest.min())) >= 1 << bits:
        found.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest = rest >> bits
    found.append(rest.astype(np.float64))
    return found


def dot_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``left @ right.T`` of int64 matrices, exact where the result is a long."""
    bits = limb_bits(left.shape[1])
    total = np.zeros((len(left), len(right)), np.int64)
    rights = limbs(right, bits)
    for i, a in enumerate(limbs(left, bits)):
        for j, b in enumerate(rights):
            if bits * (i + j) < 64:
                total += (a @ b.T).astype(np.int64) << np.int64(bits * (i + j))
    return total


def _largest(values: np.ndarray) -> int:
    return max(int(values.max(initial=0)), -int(values.min(initial=0)))


def nearest(part: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``part`` the first nearest entry and its squared distance."""
    most = _largest(part) + _largest(book)
    if most * most * part.shape[1] >= _LONG:
        raise OverflowError("a squared distance of these vectors cannot be a long")
    own = (part * part).sum(axis=1)
    away = (book * book).sum(axis=1) - 2 * dot_products(part, book)
    code = away.argmin(axis=1)
    return code, own + away[np.arange(len(part)), code]


def whole_numbers(column: pa.Array, width: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column that can be used, and their ``floor(scale * x)``."""
    present = np.flatnonzero(~column.is_null().to_numpy(zero_copy_only=False))
    rows = column.take(pa.array(present))
    flat = rows.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    sizes = np.asarray(rows.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    row = np.repeat(np.arange(len(present)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    usable = np.isfinite(flat)
    bad = np.zeros(len(present), bool)
    bad[row[~usable]] = True
    usable &= ~bad[row]
    scaled = np.floor(flat[usable] * scale)
    if np.abs(scaled).max(initial=0.0) >= float(1 << 62):
        raise OverflowError("a component cannot be a long")
    out = np.zeros((len(present), width), np.int64)
    out[row[usable], place[usable]] = scaled.astype(np.int64)
    return present[~bad], out[~bad]


class Codebooks:
    """One codebook for each part, as arrays of entries by component."""

    def __init__(self, vectors: np.ndarray, parts: int):
        self.books = [np.ascontiguousarray(b) for b in np.split(vectors, parts, axis=1)]

    @property
    def width(self) -> int:
        return self.books[0].shape[1]

    def split(self, vectors: np.ndarray) -> list[np.ndarray]:
        return [np.ascontiguousarray(p) for p in np.split(vectors, len(self.books), axis=1)]

    def sha256(self) -> str:
        """Of all components in order of part, entry and place."""
        flat = np.concatenate([b.reshape(-1) for b in self.books])
        return hashlib.sha256(",".join(map(str, flat.tolist())).encode()).hexdigest()


def _numbers(column: str):
    """Components as doubles; nulls among them stay."""
    return F.col(column).cast("array<double>")


def starting_books(vectors: DataFrame, parts: int, entries: int, scale: int) -> Codebooks | None:
    """Codebooks of the vectors with the smallest ids; none if there are no vectors.

    The driver receives ``entries`` vectors.
    """
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    usable = vectors.where(F.col("embedding").isNotNull()).where(finite)
    longest = usable.agg(F.max(F.size("embedding"))).first()[0]
    if longest is None:
        return None
    width = max(1, -(-longest // parts)) * parts
    whole = F.transform("embedding", lambda x: F.floor(x * scale))
    ordered = usable.orderBy(F.asc_nulls_last("vec_id"), whole).limit(entries).select("embedding")
    held = ordered.toArrow().column("embedding").combine_chunks()
    return Codebooks(whole_numbers(held, width, scale)[1], parts)


def _sums(batches: Iterator[pa.RecordBatch], books: Codebooks, scale: int) -> Iterator[pa.RecordBatch]:
    """One row for each part and entry that a task met: how many parts, and their sum."""
    parts, entries, width = len(books.books), len(books.books[0]), books.width
    count = np.zeros((parts, entries), np.int64)
    total = np.zeros((parts, entries, width), np.int64)
    reached = 0
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            _, vectors = whole_numbers(batch.column("embedding").slice(at, ROWS), parts * width, scale)
            reached += _largest(vectors) * len(vectors)
            if reached >= _LONG:
                raise OverflowError("the sum of these vectors cannot be a long")
            for p, part in enumerate(books.split(vectors)):
                code, _ = nearest(part, books.books[p])
                order = np.argsort(code, kind="stable")
                used, first = np.unique(code[order], return_index=True)
                if len(used):
                    total[p, used] += np.add.reduceat(part[order], first, axis=0)
                    count[p, used] += np.diff(np.append(first, len(order)))
    part, entry = np.nonzero(count)
    lists = pa.ListArray.from_arrays(
        pa.array(np.arange(len(part) + 1) * width, pa.int32()), pa.array(total[part, entry].reshape(-1))
    )
    yield pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]), lists],
        names=["part", "entry", "n", "sums"],
    )


def improved(vectors: DataFrame, books: Codebooks, scale: int) -> Codebooks:
    """Codebooks whose entries are the floors of the means of the parts next to them."""
    added = vectors.select("embedding").mapInArrow(
        lambda it: _sums(it, books, scale), "part int, entry int, n long, sums array<long>"
    )
    sums = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(books.width)]
    found = added.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).toArrow()
    part, entry, n = (found.column(c).to_numpy() for c in ("part", "entry", "n"))
    means = np.stack([found.column(f"s{i}").to_numpy() // n for i in range(books.width)], axis=1)
    new = [b.copy() for b in books.books]
    for p in range(len(new)):
        new[p][entry[part == p]] = means[part == p]
    return Codebooks(np.concatenate(new, axis=1), len(new))


def train(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> Codebooks | None:
    """Codebooks of ``embedding``, started from the smallest ``vec_id``; None without vectors."""
    narrow = vectors.select("vec_id", _numbers("embedding").alias("embedding"))
    books = starting_books(narrow, parts, entries, scale)
    for _ in range(rounds if books else 0):
        books = improved(narrow, books, scale)
    return books


def _codes(batches: Iterator[pa.RecordBatch], books: Codebooks, scale: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            some = batch.slice(at, ROWS)
            kept, vectors = whole_numbers(some.column("embedding"), len(books.books) * books.width, scale)
            found = [nearest(part, book) for part, book in zip(books.split(vectors), books.books, strict=True)]
            error = np.sum([away for _, away in found], axis=0, dtype=np.int64)
            codes = np.stack([code for code, _ in found], axis=1).astype(np.int32)
            starts = pa.array(np.arange(len(kept) + 1) * len(found), pa.int32())
            rows = pa.array(kept)
            yield pa.RecordBatch.from_arrays(
                [
                    *(some.column(c).take(rows) for c in some.schema.names if c != "embedding"),
                    pa.ListArray.from_arrays(starts, pa.array(codes.reshape(-1))),
                    pa.array(error),
                ],
                names=[*(c for c in some.schema.names if c != "embedding"), "codes", "error"],
            )


def encode(vectors: DataFrame, books: Codebooks | None, *carried: str, scale: int = SCALE) -> DataFrame:
    """``carried`` columns, ``codes`` (an entry number for each part) and ``error``, the squared
    distance that the codes leave."""
    kinds = [f"`{c}` {vectors.schema[c].dataType.simpleString()}" for c in carried]
    schema = ", ".join([*kinds, "codes array<int>, error long"])
    narrow = vectors.select(*carried, _numbers("embedding").alias("embedding"))
    if books is None:
        return vectors.sparkSession.createDataFrame([], schema)
    return narrow.mapInArrow(lambda it: _codes(it, books, scale), schema)


def with_label_error(encoded: DataFrame, label: str = "label") -> DataFrame:
    """``encoded`` with ``label_error``, the ``error`` of all rows of the same label.

    Errors are added up before they are joined, so a label of many rows moves one row per
    task; without a label counts as a label.
    """
    held = settle_table(encoded, "codes")
    total = held.groupBy(F.col(label).alias("_label")).agg(F.sum("error").alias("label_error"))
    return held.join(side(total), F.col(label).eqNullSafe(F.col("_label"))).drop("_label")

"""Exact top-k search by inner product over an impact-ordered index, score at a time.

Vectors become whole numbers, ``floor(1024 * x)``.  The index is cut into segments of some
thousand vectors; a segment holds for each component (the "term") the postings of all its
vectors in the order of their value, with the first posting of each of ``LEVELS`` value
levels.  A query takes the posting ranges of all components in descending impact (query
component times value), one power of two at a time.  After each step, no posting that is left
adds more than the step's limit, so a vector whose sum so far plus that limit for each of
its missing components stays below the ``k``-th exact score known cannot be a member.  When few vectors
remain possible, they are scored exactly; the others are proven out.

Queries are sent in blocks of a bounded number, each block one pass over the index; each
task returns ``k`` rows a query, whatever its number of segments.

Defined cases: vectors that are null or hold a null or non-finite component take no part,
nor do rows without an id; components a vector does not have count as 0; equal scores are ordered by id, then by
file and place; with fewer than ``k`` candidates all are returned; vectors whose inner product
cannot be a long raise ``OverflowError``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyport.llm.order import with_rows
from tallyport.runtime import settle_table

SCALE = 1024
SEGMENT = 8192
LEVELS = 64
STEPS = 6
#: Queries of one pass over the index.
BLOCK = 2000


def whole_numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Usable rows of a vector column, and their values as a matrix."""
    kept = np.flatnonzero(~column.is_null().to_numpy(zero_copy_only=False))
    rows = column.take(pa.array(kept))
    flat = rows.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    sizes = np.asarray(rows.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    row = np.repeat(np.arange(len(kept)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    bad = np.zeros(len(kept), bool)
    bad[row[~np.isfinite(flat)]] = True
    out = np.zeros((len(kept), int(sizes.max(initial=0))), np.int64)
    usable = np.isfinite(flat)
    usable &= ~bad[row]
    scaled = np.floor(flat[usable] * SCALE)
    if np.abs(scaled).max(initial=0.0) >= float(1 << 62):
        raise OverflowError("a component cannot be a long")
    out[row[usable], place[usable]] = scaled.astype(np.int64)
    return kept[~bad], out[~bad]


def _largest(values: np.ndarray) -> int:
    return max(int(values.max(initial=0)), -int(values.min(initial=0)))


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SEGMENT):
            part = batch.slice(at, SEGMENT)
            kept, values = whole_numbers(part.column("embedding"))
            if not len(kept):
                continue
            order = np.argsort(values, axis=0, kind="stable").astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part.column(n).take(pa.array(kept)).to_pylist()], pa.list_(pa.int64()))
                    for n in ("row", "vec_id")
                ]
                + [
                    pa.array([values.astype(np.int32 if _largest(values) < 1 << 31 else np.int64).tobytes()], pa.binary()),
                    pa.array([np.ascontiguousarray(order.T).tobytes()], pa.binary()),
                ],
                names=["rows", "ids", "values", "postings"],
            )


def _numbered(vectors: DataFrame) -> DataFrame:
    """Rows with an id; the index and the queries know a row by the same number."""
    return with_rows(vectors).where("doc.vec_id is not null")


def build_index(vectors: DataFrame) -> DataFrame:
    """One row per segment: ``rows, ids``, the ``values`` by vector and the ``postings`` by
    component (places of vectors in the order of their value)."""
    narrow = _numbered(vectors).select("row", F.col("doc.vec_id").cast("long").alias("vec_id"), "doc.embedding")
    kind = "rows array<long>, ids array<long>, values binary, postings binary"
    return settle_table(narrow.mapInArrow(_index, kind), "impacts")


class Segment:
    """A segment of the index, opened in a task."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, values: bytes, postings: bytes):
        self.rows, self.ids = rows, ids
        self.dims = len(postings) // 4 // len(ids)
        wide = len(values) > 4 * len(ids) * self.dims
        flat = np.frombuffer(values, np.int64 if wide else np.int32)
        self.values = flat.reshape(len(ids), self.dims).astype(np.int64)
        self.largest = _largest(self.values)
        self.postings = np.frombuffer(postings, np.int32).reshape(self.dims, len(ids))
        ordered = np.take_along_axis(self.values.T, self.postings.astype(np.int64), axis=1)
        self.ordered = ordered
        self.low = ordered[:, 0] if len(ids) else np.zeros(self.dims, np.int64)
        self.width = (ordered[:, -1] - self.low) // LEVELS + 1
        level = (ordered - self.low[:, None]) // self.width[:, None]
        self.starts = np.stack([np.searchsorted(x, np.arange(LEVELS + 2)) for x in level])

    def search(self, query: np.ndarray, own: int, k: int, known: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Exact scores and places of all vectors that can be among the best ``k``.

        ``known`` is a score that ``k`` vectors of other segments reach.
        """
        count, dims = len(self.ids), min(self.dims, len(query))
        q = query[:dims]
        if self.largest * _largest(q) * dims >= 1 << 63:
            raise OverflowError("an inner product of these vectors cannot be a long")
        other = self.rows != own
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        # The largest impact of each component.
        best = np.maximum(q * self.ordered[:dims, -1], q * self.ordered[:dims, 0])
        limit = int(best.max(initial=0))
        # What sums of floating-point numbers may be off.
        unsure = 1e-15 * dims * dims * float(self.largest) * float(_largest(q))
        total, seen = np.zeros(count), np.zeros(count, np.int64)
        done = np.where(q > 0, count, 0)
        possible = np.flatnonzero(other)
        active = len(up) + len(down)
        for step in range(1, STEPS + 1):
            if limit <= 0:
                break
            least = 0 if step == STEPS else limit >> step
            # Whole levels that may hold an impact of ``least`` or more.
            begin, end = np.zeros(dims, np.int64), np.zeros(dims, np.int64)
            level = (-(-least // q[up]) - self.low[up]) // self.width[up]
            begin[up], end[up] = self.starts[up, np.clip(level, 0, LEVELS)], done[up]
            level = (least // q[down] - self.low[down]) // self.width[down]
            begin[down], end[down] = done[down], self.starts[down, np.clip(level + 1, 0, LEVELS)]
            size = np.maximum(end - begin, 0)
            done[up], done[down] = np.minimum(begin[up], done[up]), np.maximum(end[down], done[down])
            if size.sum():
                of = np.repeat(np.arange(dims), size)
                at = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size)
                place = self.postings[of, at]
                total += np.bincount(place, (q[of] * self.ordered[of, at]).astype(np.float64), count)
                seen += np.bincount(place, minlength=count)
            bound = total + (active - seen) * float(least)
            floor = known
            if len(possible) > k:
                # The exact score of the k-th best so far is reached by k vectors.
                some = possible[np.argpartition(-total[possible], k - 1)[:k]]
                reached = int((self.values[some, :dims] @ q).min())
                floor = reached if floor is None else max(floor, reached)
            if floor is not None:
                slack = unsure + 1e-9 * (abs(floor) + np.abs(bound))
                possible = possible[(bound + slack)[possible] >= floor]
            if len(possible) * 4 <= count or len(possible) <= 4 * k:
                break
        return self.values[possible, :dims] @ q, possible


def _search(batches: Iterator[pa.RecordBatch], sent: Broadcast, k: int) -> Iterator[pa.RecordBatch]:
    own_rows, own_ids, queries = sent.value
    best: list[list[tuple]] = [[] for _ in own_ids]
    for batch in batches:
        for i in range(batch.num_rows):
            rows, ids = (batch.column(n)[i].values.to_numpy() for n in ("rows", "ids"))
            segment = Segment(rows, ids, batch.column("values")[i].as_py(), batch.column("postings")[i].as_py())
            for j in range(len(own_ids)):
                known = -best[j][-1][0] if len(best[j]) >= k else None
                scores, places = segment.search(queries[j], own_rows[j], k, known)
                order = np.lexsort((rows[places], ids[places], -scores))[:k]
                found = zip((-scores[order]).tolist(), ids[places[order]].tolist(), rows[places[order]].tolist())
                best[j] = sorted([*best[j], *found])[:k]
    out = [(int(own_ids[j]), int(own_rows[j]), i, r, -s) for j, held in enumerate(best) for s, i, r in held]
    names = ["query_id", "query_row", "vec_id", "vec_row", "score"]
    columns = list(zip(*out)) or [[]] * 5
    yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=names)


def search(index: DataFrame, vectors: DataFrame, wanted: Column, k: int = 10, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best other rows of each row of
    ``vectors`` where ``wanted`` holds."""
    spark = index.sparkSession
    chosen = _numbered(vectors.withColumn("_wanted", wanted)).where("doc._wanted")
    rows = chosen.select("row", F.col("doc.vec_id").cast("long").alias("vec_id"), "doc.embedding")
    queries = settle_table(rows, "queries")
    blocks = max(1, -(-queries.count() // block))
    part = F.pmod(F.xxhash64("row"), F.lit(blocks))
    passes = []
    for number in range(blocks):
        held = queries.where(part == number).orderBy("row").toArrow()  # about ``block`` vectors
        kept, values = whole_numbers(held.column("embedding").combine_chunks())
        own = [held.column(n).to_numpy()[kept] for n in ("row", "vec_id")]
        sent = spark.sparkContext.broadcast((*own, values))
        passes.append(
            index.mapInArrow(
                lambda it, sent=sent: _search(it, sent, k),
                "query_id long, query_row long, vec_id long, vec_row long, score long",
            )
        )
    found = passes[0]
    for other in passes[1:]:
        found = found.union(other)
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id", "vec_row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

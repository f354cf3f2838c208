"""Benchmark decontamination over a distributed positional inverted index.

``build_index`` turns the documents into segments: a segment holds a few thousand
neighbouring documents and, for each of its terms, the postings: the positions of the term
among all words of the segment.  Segments are written to the shared folder and need no
shuffle.  The benchmark side is a table of windows (phrases): every ``size`` consecutive
words of an item, or all its words if it has fewer.  ``find_phrases`` takes the windows in
blocks of a bounded number, and in each segment intersects the postings of a window's
terms, moved by their offset in the window, from the rarest term of the whole corpus to the
most frequent.  With ``slack`` above 0 a term may lie that many words beside its place
(proximity match).  Terms are 64-bit hashes of words.

Defined cases: a null or empty text has no words, is never hit and, as an item, gives no
window; equal items are found each under its own id; repeated documents are separate rows;
ids may be null.  A text of any length is one document of one segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.llm.order import side, with_rows
from tallyport.llm.words import PLAIN_WORDS, byte_class, find_words, pieces, text_bytes
from tallyport.runtime import settings, settle_table

SIZE = 13
#: Windows of one pass over the index: each takes ``SIZE`` terms of 8 bytes.
BLOCK = 50_000
#: Bytes of segments that a writer or a reader of the index holds at once, and one segment besides.
HELD = 8_000_000
_LETTERS = PLAIN_WORDS | byte_class((65, 90))


def _terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of a text column as signed numbers, and where each row begins."""
    data, offsets = text_bytes(column)
    words = find_words(data, offsets, _LETTERS, lower=True)
    return words.hashes.view(np.int64), words.first


def _binary_list(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Runs of ``flat`` as binary values."""
    width = flat.itemsize
    where = pa.py_buffer((bounds * width).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, where, pa.py_buffer(flat.tobytes())])


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        terms, first = _terms(batch.column("text"))
        order = np.argsort(terms, kind="stable")
        ranked = terms[order]
        begins = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, int)
        bounds = np.append(begins, len(ranked))
        steps = np.diff(order, prepend=0).astype(np.int32)
        steps[begins] = order[begins]
        yield pa.RecordBatch.from_arrays(
            [
                _one_list(batch.column("doc_id")),
                _one_list(pa.array(np.diff(first).astype(np.int32))),
                _one_list(pa.array(ranked[begins])),
                _one_list(pa.array(np.diff(bounds).astype(np.int32))),
                _one_list(_binary_list(steps, bounds)),
            ],
            names=["doc_ids", "lengths", "terms", "counts", "postings"],
        )


def build_index(docs: DataFrame) -> DataFrame:
    """Positional postings of all words of ``docs`` (``doc_id``, ``text``), one row per
    segment: ``segment, doc_ids, lengths, terms, counts, postings``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    rows = narrow.mapInArrow(
        _segments,
        f"doc_ids array<{kind}>, lengths array<int>, terms array<long>, counts array<int>, postings array<binary>",
    )
    # A segment is a row of some megabytes; by default a writer keeps a hundred rows before it looks
    # at their size, and a reader takes a row group at once.
    options = {"parquet.block.size": str(HELD), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}
    return settle_table(rows.select(F.monotonically_increasing_id().alias("segment"), "*"), "postings", **options)


def _windows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", 200_000):
        terms, first = _terms(batch.column("text"))
        count = np.diff(first)
        each = np.where(count >= size, count - size + 1, np.minimum(count, 1))
        row = np.repeat(np.arange(len(each)), each)
        start = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each) + first[row]
        width = np.minimum(count[row], size)
        ends = np.cumsum(width)
        flat = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - width, width) + np.repeat(start, width)
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(terms[flat]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id").take(pa.array(row)), lists], names=["item_id", "window"]
        )


def windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """``item_id`` and ``window``, the terms of each window of each item."""
    kind = benchmark.schema["item_id"].dataType.simpleString()
    narrow = benchmark.select(F.col("item_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(lambda it: _windows(it, size), f"item_id {kind}, window array<long>")


def ranked_windows(index: DataFrame, cut: DataFrame) -> DataFrame:
    """Add ``places`` to windows: the offsets of their terms, rarest term of the corpus first.

    Only terms of windows are counted, and equal ones are counted before they are shuffled.
    """
    held = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
    uses = cut.select("item_id", "window", F.posexplode("window").alias("place", "term"))
    wanted = side(uses.select("term").distinct())
    counts = held.select(F.col("x.terms").alias("term"), F.col("x.counts").cast("long").alias("n"))
    frequency = counts.join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n"))
    known = uses.join(frequency, "term", "left")
    keyed = known.groupBy("item_id", "window").agg(
        F.array_sort(F.collect_set(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place"))).alias("ranks"),
    )
    # A window whose rarest term does not occur at all cannot match.
    found = keyed.where(F.col("ranks")[0]["n"] > 0)
    return found.select("item_id", "window", F.col("ranks.place").alias("places"))


def _lookup(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each key is in a sorted array, or -1."""
    at = np.searchsorted(sorted_keys, keys)
    at[at == len(sorted_keys)] = 0
    return np.where(sorted_keys[at] == keys, at, -1) if len(sorted_keys) else np.full(len(keys), -1)


def _in_segment(row: dict, block: tuple, slack: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents (by place in the segment), windows and first word of all matches."""
    table, order, widths = block  # terms by window and rank, their offsets, window lengths
    terms = row["terms"]
    none = np.zeros(0, np.int64)
    where = _lookup(terms, table.ravel()).reshape(table.shape)
    used = np.arange(table.shape[1])[None, :] < widths[:, None]
    alive = np.flatnonzero(((where >= 0) | ~used).all(axis=1))
    if not len(alive):
        return none, none, none
    lengths = row["lengths"]
    first = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    # Decode only the postings that some window asks for, as one sorted array of
    # (term, position) pairs.
    need = np.unique(where[alive][used[alive]])
    number = np.full(len(terms), -1)
    number[need] = np.arange(len(need))
    lists = [np.cumsum(np.frombuffer(row["postings"][int(t)], np.int32), dtype=np.int64) for t in need]
    count = np.array([len(x) for x in lists])
    begins = np.concatenate([[0], np.cumsum(count)])
    span = int(first[-1]) + 2 * (slack + 1) + 1
    pairs = np.concatenate(lists) + slack + 1 + np.repeat(np.arange(len(need)), count) * span

    rank = number[where]
    # Start from the postings of each window's rarest term.
    anchor = rank[alive, 0]
    many = count[anchor]
    window = np.repeat(alive, many)
    inside = np.arange(len(window)) - np.repeat(np.cumsum(many) - many, many)
    start = pairs[begins[np.repeat(anchor, many)] + inside] - np.repeat(anchor, many) * span - slack - 1
    start = start - order[window, 0]
    document = np.searchsorted(first, start + order[window, 0], "right") - 1
    keep = (start >= first[document]) & (start + widths[window] <= first[document + 1])
    window, start, document = window[keep], start[keep], document[keep]
    for step in range(1, table.shape[1]):
        if not len(window):
            break
        needed = step < widths[window]
        goal = start + order[window, step] + slack + 1 + rank[window, step] * span
        # The first posting at or after the earliest allowed place.
        at = np.searchsorted(pairs, goal - slack)
        near = (at < len(pairs)) & (pairs[np.minimum(at, len(pairs) - 1)] <= goal + slack)
        keep = near | ~needed
        window, start, document = window[keep], start[keep], document[keep]
    return document, window, start - first[document]


def _runs(document, item, start, width) -> tuple[np.ndarray, ...]:
    """Join matches of one document and item that touch or overlap."""
    order = np.lexsort((start, item, document))
    document, item, start, end = document[order], item[order], start[order], (start + width)[order]
    if not len(order):
        return document, item, start, end
    group = np.concatenate([[0], np.cumsum((document[1:] != document[:-1]) | (item[1:] != item[:-1]))])
    # Ends grow with starts except for windows of differing width; carry the largest per group.
    reach = np.maximum.accumulate(end + group * (1 << 40)) - group * (1 << 40)
    new = np.concatenate([[True], (group[1:] != group[:-1]) | (start[1:] > reach[:-1])])
    begins = np.flatnonzero(new)
    last = np.append(begins[1:], len(order)) - 1
    return document[begins], item[begins], start[begins], reach[last]


def _search(batches: Iterator[pa.RecordBatch], block, slack: int) -> Iterator[pa.RecordBatch]:
    table, order, widths, item, ids = block.value
    for batch in batches:
        for i in range(batch.num_rows):
            one = {n: batch.column(n)[i].values for n in ("doc_ids", "lengths", "terms", "postings")}
            lengths, terms = one["lengths"].to_numpy(), one["terms"].to_numpy()
            row = {"lengths": lengths, "terms": terms, "postings": _Views(one["postings"])}
            document, window, start = _in_segment(row, (table, order, widths), slack)
            document, found, start, end = _runs(document, item[window], start, widths[window])
            cuts = np.searchsorted(document, np.arange(len(lengths) + 1)).astype(np.int32)
            spans = pa.StructArray.from_arrays(
                [ids.take(pa.array(found)), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))],
                names=["item", "first", "end"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(lengths), batch.column("segment")[i].as_py())),
                    pa.array(np.arange(len(lengths), dtype=np.int32)),
                    one["doc_ids"],
                    pa.array(lengths.astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(cuts), spans),
                ],
                names=["segment", "place", "doc_id", "n_words", "spans"],
            )


class _Views:
    """Values of a binary array without copies."""

    def __init__(self, values: pa.Array):
        self.bounds = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
        self.data = values.buffers()[2]

    def __getitem__(self, i: int):
        return memoryview(self.data)[self.bounds[i] : self.bounds[i + 1]] if self.data is not None else b""


def find_phrases(index: DataFrame, benchmark: DataFrame, size: int = SIZE, slack: int = 0, block: int = BLOCK) -> DataFrame:
    """One row per document: ``segment, place, doc_id, n_words, spans``.

    ``spans`` lists ``item`` (its id), ``first`` and ``end`` of the words that windows of the
    item cover.  Each block of windows is one pass over the index, which hands a worker one
    segment at a time; the results of several passes are joined by segment and place.
    """
    spark = index.sparkSession
    ready = settle_table(ranked_windows(index, windows(benchmark, size)), "windows")
    total = ready.count()
    blocks = max(1, -(-total // block))
    part = F.pmod(F.xxhash64("item_id", "window"), F.lit(blocks))
    kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = (
        f"segment long, place int, doc_id {index.schema['doc_ids'].dataType.elementType.simpleString()}, "
        f"n_words long, spans array<struct<item: {kind}, first: int, end: int>>"
    )
    passes = []
    for number in range(blocks):
        # About ``block`` windows, whatever the size of the benchmark.
        held = ready.where(part == number).toArrow()
        widths = held.column("window").combine_chunks().value_lengths().to_numpy().astype(np.int64)
        table = np.zeros((len(widths), size), np.int64)
        order = np.zeros((len(widths), size), np.int64)
        used = np.arange(size)[None, :] < widths[:, None]
        for target, name in ((order, "places"), (table, "window")):
            values = held.column(name).combine_chunks()
            target[used] = values.flatten().to_numpy()
        table = np.take_along_axis(table, order, axis=1)
        items = held.column("item_id").combine_chunks().dictionary_encode(null_encoding="encode")
        codes = items.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        sent = spark.sparkContext.broadcast((table, order, widths, codes, items.dictionary))
        with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch="1"):
            passes.append(settle_table(index.mapInArrow(lambda it, sent=sent: _search(it, sent, slack), schema), "found"))
    if len(passes) == 1:
        return passes[0]
    whole = passes[0]
    for other in passes[1:]:
        whole = whole.union(other)
    return whole.groupBy("segment", "place").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
    )


def contamination(found: DataFrame, share: int = 20) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, n_items, items, contaminated``.

    A word inside any span is hit; a document is contaminated if at least one in ``share``
    of its words is hit.
    """
    # Spans in the order of their start; a word counts from the end of the spans before.
    order = F.array_sort(F.transform("spans", lambda s: F.struct(s["first"].alias("first"), s["end"].alias("end"))))
    start = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("upto"))
    hit = F.aggregate(
        order,
        start,
        lambda a, s: F.struct(
            (a["hit"] + F.greatest(s["end"] - F.greatest(s["first"], a["upto"]), F.lit(0))).alias("hit"),
            F.greatest(s["end"], a["upto"]).alias("upto"),
        ),
        lambda a: a["hit"],
    )
    rows = found.select("segment", "place", "doc_id", "n_words", hit.alias("n_hit"), F.array_distinct("spans.item").alias("items"))
    return rows.select(
        "*",
        F.size("items").cast("long").alias("n_items"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, share: int = 20) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    whole = with_rows(docs)
    plain = whole.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text"))
    found = contamination(find_phrases(build_index(plain), benchmark, size), share)
    bad = found.where("contaminated").select(F.col("doc_id").alias("row"))
    return whole.join(side(bad), "row", "left_anti").select("doc.*")

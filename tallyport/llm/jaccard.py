"""Joining documents whose sets of word shingles are alike: a size-aware heavy-light join.

Two sets are linked when ``100 * intersection >= percent * union``.  Equal sets are one
vertex.  For the others, the pairs are dealt out by the size class of the larger set (sizes
of a class differ by the factor ``percent / 100`` at most, so a set takes part in its own
class and in the next):

* light classes: every linked pair shares a subset of ``k`` elements, the smallest overlap of the class.
  All ``k``-subsets of a set are enumerated as keys.
* heavy classes: the hash space is cut into ``b`` ranges, more than the elements in which a
  linked pair can differ, so a pair has a range in which both hold the same elements.  An
  inverted list is kept for the content of each range, and a set scans its ``b`` lists.
  There are some ranges to spare: a set that fills more of them than it can differ in from
  any partner agrees with each in a filled one, so only the few others list their empty
  ranges, which would chain unlike sets together.

A class is light if a set has no more subsets than ``SCAN_COST`` times its lists.  Lists
give candidate edges from each member to the list's first; those are combined where they
arise, so a list as long as the table costs one row per batch.

Passages that many documents share can chain unlike sets to one large candidate component.
A set of it that has a partner shares at least ``percent`` of its elements with another; so
elements that occur once in the component are counted out, sets with fewer shared elements leave
it, and the others list their keys again, until that no longer helps.  Candidate components are
then checked exactly: sets come together by component, a large component in pairs of cells
of bounded size, and each task scans the inverted lists of the single elements.  A task
returns one edge for each set it could join.  No step emits the pairs of a group.

Elements are 64-bit hashes of shingles, a set is known by 128 bits of hash.  Elements take more
room than the texts and cannot be compressed, so they are never stored: each step that needs
them makes them anew from the texts.

Defined cases: a text of fewer words is one shingle of all its words; no words, an empty or
a null text give the empty set, linked with nothing, not even its like; repeated rows and
ids are separate rows; a null id never names a component unless all its rows have none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyport.llm.graph import components
from tallyport.llm.order import side, with_rows
from tallyport.llm.words import BLANK_WORDS, find_words, mixed, ngrams, pieces, text_bytes
from tallyport.runtime import default_partitions, settle_table

SCAN_COST = 8
#: Elements in one cell of a large component.
CELL = 1 << 17
#: Sets that a task compares with all others before it scans lists.
HUBS = 32
#: Sets of large components list their keys again if less than this share of them is left.
LEFT = 0.9


@dataclass(frozen=True)
class Rule:
    words: int
    percent: int

    def overlap(self, n: int, m: int) -> int:
        """The smallest intersection of linked sets of sizes ``n`` and ``m``."""
        return -(-self.percent * (n + m) // (100 + self.percent))

    def size_class(self, n: np.ndarray) -> np.ndarray:
        edges = self.class_starts(int(n.max(initial=1)))
        return np.searchsorted(edges, n, "right") - 1

    def class_starts(self, upto: int) -> np.ndarray:
        """First size of each class; from any size in a class, a partner that is smaller
        and linked is in the same class or the one before."""
        starts = [1]
        while starts[-1] <= upto:
            starts.append(max(starts[-1] + 1, starts[-1] * 100 // self.percent + 1))
        return np.array(starts)

    def spread(self, top: int) -> int:
        """The most elements in which linked sets can differ, the larger of size ``top``."""
        # union <= (n + m) * 100 / (100 + percent), and what differs is the rest of the union.
        return 2 * top * (100 - self.percent) // (100 + self.percent)

    def ranges(self, top: int) -> int:
        """Ranges of the hash space for a heavy class up to size ``top``: an eighth to spare."""
        return self.spread(top) * 9 // 8 + 2

    def reach(self, n: np.ndarray, top: np.ndarray) -> np.ndarray:
        """The most elements in which a set of size ``n`` can differ from a partner of size
        ``top`` or less."""
        partner = np.minimum(top, n * 100 // self.percent)
        return (n + partner) * (100 - self.percent) // (100 + self.percent)

    def light(self, low: int, top: int) -> int:
        """The subset size of a light class, 0 for a heavy one."""
        k = -(-self.percent * low // 100)
        return k if math.comb(top, k) <= SCAN_COST * (self.spread(top) + 1) else 0


def shingle_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each row, flat, and where each row begins."""
    data, offsets = text_bytes(column)
    found = find_words(data, offsets, BLANK_WORDS, lower=True)
    count = found.counts
    rows = found.rows()
    grams = ngrams(found.hashes, words)
    whole = rows[: len(grams)] == rows[words - 1 :] if len(grams) else np.zeros(0, bool)
    grams, gram_rows = grams[whole], rows[: len(grams)][whole]
    few = np.flatnonzero((count > 0) & (count < words))
    if len(few):
        extra = np.array([ngrams(found.hashes[found.first[r] : found.first[r + 1]], int(count[r]))[0] for r in few])
        # Shingles of other lengths must not meet by chance of construction.
        extra = mixed(extra + count[few].astype(np.uint64))
        grams, gram_rows = np.concatenate([grams, extra]), np.concatenate([gram_rows, few])
    order = np.lexsort((grams, gram_rows))
    grams, gram_rows = grams[order], gram_rows[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (gram_rows[1:] != gram_rows[:-1])
    grams, gram_rows = grams[new], gram_rows[new]
    return grams, np.searchsorted(gram_rows, np.arange(len(count) + 1))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[first[1:]] - total[first[:-1]]


def _marks(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    return _sums(mixed(grams), first)


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", 1_000_000):
        grams, first = shingle_sets(batch.column("text"), words)
        size = np.diff(first)
        one = _marks(grams, first)
        two = mixed(_sums(mixed(grams ^ np.uint64(0x5851F42D4C957F2D)), first) + size.astype(np.uint64))
        both = np.stack([one, two], axis=1).tobytes()
        bounds = np.arange(len(size) + 1, dtype=np.int32) * 16
        vertex = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(bounds), pa.py_buffer(both)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), pa.array(size), vertex, pa.array(one.view(np.int64))],
            names=["row", "doc_id", "n", "vertex", "mark"],
        )


def document_sets(texts: DataFrame, rule: Rule) -> DataFrame:
    """Per row of ``texts`` (``row, doc_id, text``) ``row, doc_id, n, vertex`` (128 bits) and ``mark``
    (its first half), written to the shared folder."""
    kind = texts.schema["doc_id"].dataType.simpleString()
    words = rule.words
    rows = texts.select("row", "doc_id", "text").mapInArrow(
        lambda it: _sets(it, words), f"row long, doc_id {kind}, n long, vertex binary, mark long"
    )
    return settle_table(rows, "sets")


def _elements(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """``text`` replaced by the sorted ``elements``."""
    for batch in pieces(batches, "text", 1_000_000):
        grams, first = shingle_sets(batch.column("text"), words)
        where = pa.py_buffer((first * 8).astype(np.int32))
        sets = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, where, pa.py_buffer(grams.tobytes())])
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), sets], names=[*names, "elements"])


def with_elements(texts: DataFrame, rule: Rule) -> DataFrame:
    """All columns of ``texts`` with ``elements`` instead of ``text``."""
    words = rule.words
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema if f.name != "text"]
    return texts.mapInArrow(lambda it: _elements(it, words), ", ".join([*kinds, "elements binary"]))


def list_keys(grams: np.ndarray, first: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all sets and the set of each key."""
    size = np.diff(first)
    if not len(size) or not size.max(initial=0):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    own = rule.size_class(np.maximum(size, 1))
    starts = rule.class_starts(int(size.max()) * 2 + 2)
    keys, owners = [], []
    spread_out = mixed(grams)
    for ahead in (0, 1):
        of = own + ahead
        k = np.zeros(len(size), np.int64)
        b = np.zeros(len(size), np.int64)
        for c in np.unique(of):
            low, top = int(starts[c]), int(starts[c + 1]) - 1
            k[of == c] = rule.light(low, top)
            b[of == c] = rule.ranges(top)
        seed = mixed(of.astype(np.uint64) * np.uint64(2654435761) + np.uint64(7))
        for r in np.flatnonzero((k > 0) & (size >= k)):
            some = spread_out[first[r] : first[r + 1]]
            with np.errstate(over="ignore"):
                sums = np.array([s.sum(dtype=np.uint64) for s in map(np.array, combinations(some, int(k[r])))])
                keys.append(mixed(sums ^ seed[r]))
            owners.append(np.full(len(sums), r))
        heavy = (k == 0) & (size > 0)
        chosen = np.repeat(heavy, size)
        if not chosen.any():
            continue
        row = np.repeat(np.arange(len(size)), size)[chosen]
        values = grams[chosen]
        # Elements are sorted, so each range of the hash space is a run.
        part = (((values >> np.uint64(32)) * b[row].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (part[1:] != part[:-1])
        begins = np.flatnonzero(new)
        content = np.add.reduceat(spread_out[chosen], begins)
        with np.errstate(over="ignore"):
            keys.append(mixed(mixed(content ^ seed[row[begins]]) + part[begins].astype(np.uint64)))
        owners.append(row[begins])
        # Linked sets that both fill no more ranges than they can differ in may agree in empty ones only.
        filled = np.bincount(row[begins], minlength=len(size))
        for r in np.flatnonzero(heavy & (filled <= rule.reach(size, starts[of + 1] - 1))):
            empty = np.setdiff1d(np.arange(b[r]), part[begins][row[begins] == r])
            keys.append(mixed(mixed(np.zeros(len(empty), np.uint64) ^ seed[r]) + empty.astype(np.uint64)))
            owners.append(np.full(len(empty), r))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


def _by_key(keys: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each key with its smallest mark, and the edges to it from the other marks."""
    order = np.lexsort((marks, keys))
    keys, marks = keys[order], marks[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    begins = np.flatnonzero(new)
    lows = np.repeat(marks[begins], np.diff(np.append(begins, len(keys))))
    other = lows != marks
    edges = np.unique(np.stack([lows[other], marks[other]], axis=1), axis=0)
    return keys[begins], marks[begins], edges[:, 0], edges[:, 1]


def _post(batches: Iterator[pa.RecordBatch], rule: Rule, buckets: int) -> Iterator[pa.RecordBatch]:
    """Per batch and bucket of the key space, the keys with one mark each, packed; and the
    candidate edges within the batch, spread over the buckets."""
    for batch in pieces(batches, "text", 1_500_000):
        grams, first = shingle_sets(batch.column("text"), rule.words)
        marks = _marks(grams, first).view(np.int64)
        keys, owners = list_keys(grams, first, rule)
        keys, lows, a, b = _by_key(keys, marks[owners])
        names, codes = np.unique(lows, return_inverse=True)
        bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        filled = np.flatnonzero(np.diff(cuts))
        packed = []
        for i in filled:
            some, code = keys[cuts[i] : cuts[i + 1]], codes[cuts[i] : cuts[i + 1]]
            own, code = np.unique(code, return_inverse=True)
            head = np.array([len(some), len(own)], np.uint32).tobytes()
            code = code.astype(np.uint16 if len(own) < 1 << 16 else np.uint32)
            packed.append(head + some.tobytes() + names[own].tobytes() + code.tobytes())
        zeros = np.zeros(len(filled), np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([filled, np.abs(b) % buckets]).astype(np.int64)),
                pa.array(packed + [None] * len(a), pa.binary()),
                pa.array(np.concatenate([zeros, a])),
                pa.array(np.concatenate([zeros, b])),
            ],
            names=["bucket", "packed", "a", "b"],
        )


def _scan(frame: pd.DataFrame) -> pd.DataFrame:
    """Candidate edges of one bucket of keys, with those found before."""
    keys, marks = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    lists = frame["packed"].notna()
    for packed in frame["packed"][lists]:
        count, own = np.frombuffer(packed, np.uint32, 2).tolist()
        keys.append(np.frombuffer(packed, np.uint64, count, 8))
        names = np.frombuffer(packed, np.int64, own, 8 + 8 * count)
        code = np.frombuffer(packed, np.uint16 if own < 1 << 16 else np.uint32, count, 8 + 8 * (count + own))
        marks.append(names[code])
    _, _, a, b = _by_key(np.concatenate(keys), np.concatenate(marks))
    return pd.concat([pd.DataFrame({"a": a, "b": b}), frame.loc[~lists, ["a", "b"]]])


def candidate_edges(texts: DataFrame, total: int, rule: Rule) -> DataFrame:
    """``a``, ``b``: marks of ``texts``, which have about ``total`` elements, that stand in one list."""
    # About two keys in each class per element that may differ; some million keys a bucket.
    keys = total * 2 * (rule.ranges(1000) / 1000 + 0.02) * 1.1
    buckets = max(default_partitions(texts.sparkSession), math.ceil(keys / 1_000_000))
    posted = texts.select("text").mapInArrow(
        lambda it: _post(it, rule, buckets), "bucket long, packed binary, a long, b long"
    )
    return posted.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(_scan, "a long, b long").distinct()


def _send_elements(batches: Iterator[pa.RecordBatch], words: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Per batch and bucket the elements with their sets, packed; and the rows of the batch."""
    for batch in pieces(batches, "text", 1_500_000):
        grams, first = shingle_sets(batch.column("text"), words)
        row = batch.column("row").to_numpy()
        group = batch.column("group").to_numpy().view(np.uint64)
        code = np.repeat(np.arange(len(row), dtype=np.uint32), np.diff(first))
        keys = mixed(grams ^ mixed(group)[code])
        order = np.argsort(keys)
        keys, code = keys[order], code[order]
        bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        filled = np.flatnonzero(np.diff(cuts))
        packed = [keys[a:b].tobytes() + code[a:b].tobytes() for a, b in zip(cuts[filled], cuts[filled + 1], strict=True)]
        base = int(row[0])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*filled.tolist(), base % buckets], pa.int64()),
                pa.array([base] * (len(packed) + 1), pa.int64()),
                pa.array([*packed, None], pa.binary()),
                pa.array([None] * len(packed) + [row.tobytes()], pa.binary()),
            ],
            names=["bucket", "base", "packed", "rows"],
        )


def _shared(frame: pd.DataFrame) -> pd.DataFrame:
    """Per batch, how many elements of this bucket each set shares with another."""
    own = frame["rows"].isna()
    keys, codes = [np.zeros(0, np.uint64)], []
    for packed in frame["packed"][own]:
        count = len(packed) // 12
        keys.append(np.frombuffer(packed, np.uint64, count))
        codes.append(np.frombuffer(packed, np.uint32, count, 8 * count))
    flat = np.concatenate(keys)
    order = np.argsort(flat)
    same = flat[order][1:] == flat[order][:-1]
    twice = np.zeros(len(flat), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cuts = np.cumsum([len(c) for c in codes])[:-1]
    some = np.split(twice, cuts) if codes else []
    counts = [np.bincount(c[t]).astype(np.int64).tobytes() for c, t in zip(codes, some, strict=True)]
    found = pd.DataFrame({"base": frame["base"][own], "packed": counts, "rows": None})
    return pd.concat([found, frame.loc[~own, ["base", "packed", "rows"]]])


def _add_up(frame: pd.DataFrame) -> pd.DataFrame:
    row = np.frombuffer(frame["rows"][frame["rows"].notna()].iloc[0], np.int64)
    total = np.zeros(len(row), np.int64)
    for packed in frame["packed"][frame["rows"].isna()]:
        some = np.frombuffer(packed, np.int64)
        total[: len(some)] += some
    return pd.DataFrame({"row": row, "shared": total})


def shared_elements(held: DataFrame, elements: int, words: int) -> DataFrame:
    """``row`` and ``shared``: how many elements of each set another set of its ``group`` holds.
    ``held``: ``row, group, text``."""
    buckets = max(default_partitions(held.sparkSession), math.ceil(elements / 1_000_000))
    sent = held.mapInArrow(
        lambda it: _send_elements(it, words, buckets), "bucket long, base long, packed binary, rows binary"
    )
    counted = sent.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(
        _shared, "base long, packed binary, rows binary"
    )
    return counted.groupBy("base").applyInPandas(_add_up, "row long, shared long")


def _find(roots: list[int], i: int) -> int:
    while roots[i] != i:
        roots[i] = roots[roots[i]]
        i = roots[i]
    return i


def linked_groups(sets: list[np.ndarray], rule: Rule) -> list[int]:
    """For each set of a task the number of another, the same for all sets joined by links.

    First some hubs are compared with all sets at once: near copies of one text are joined by
    their first.  Then each set outside the largest group scans the inverted lists of its
    elements for overlaps with all others, so every pair of sets that are not yet joined is looked at.
    """
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), size)
    roots = list(range(len(sets)))
    joined = np.zeros(len(sets), bool)

    def join(i: int, both: np.ndarray) -> np.ndarray:
        linked = 100 * both >= rule.percent * (size + size[i] - both)
        linked[i] = True
        for j in np.flatnonzero(linked).tolist():
            x, y = _find(roots, i), _find(roots, j)
            roots[x] = y
        return linked

    for _ in range(HUBS):
        loose = np.flatnonzero(~joined)
        if not len(loose):
            break
        hub = sets[loose[0]]
        at = np.minimum(np.searchsorted(hub, flat), len(hub) - 1)
        joined |= join(int(loose[0]), np.bincount(owner[hub[at] == flat], minlength=len(sets)))
    groups = np.array([_find(roots, i) for i in range(len(sets))])
    outside = np.flatnonzero(groups != np.bincount(groups).argmax()) if len(sets) else groups
    if not len(outside):
        return groups.tolist()
    order = np.argsort(flat, kind="stable")
    ranked, posts = flat[order], owner[order]
    for i in outside.tolist():
        begin = np.searchsorted(ranked, sets[i])
        count = np.searchsorted(ranked, sets[i], "right") - begin
        at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)
        join(i, np.bincount(posts[at], minlength=len(sets)))
    return [_find(roots, i) for i in range(len(sets))]


def _check(frame: pd.DataFrame, rule: Rule) -> pd.DataFrame:
    """Edges from the smallest vertex of each group of a task to its others."""
    sets = [np.frombuffer(e, np.uint64) for e in frame["elements"]]
    held = pd.DataFrame({"b": frame["vertex"], "group": linked_groups(sets, rule)})
    held["a"] = held.groupby("group")["b"].transform("min")
    return held.loc[held["a"] != held["b"], ["a", "b"]]


def candidate_groups(texts: DataFrame, sets: DataFrame, vertices: DataFrame, rule: Rule) -> DataFrame:
    """``vertex``, ``row``, ``n``, ``group`` and ``cells``, the cells of the group, of all
    vertices that may have a link."""
    found, left = None, None
    while True:
        some = texts if left is None else texts.join(left, "row", "left_semi")
        counted = sets if left is None else sets.join(left, "row", "left_semi")
        total = counted.agg(F.sum("n")).first()[0] or 0
        groups = components(candidate_edges(some, total, rule)).select(F.col("node").alias("mark"), F.col("root").alias("group"))
        chosen = settle_table(vertices.join(groups, "mark").select("mark", "vertex", "row", "n", "group"), "chosen")
        weight = chosen.groupBy("group").agg(F.ceil(F.sum("n") / CELL).cast("int").alias("cells"))
        chosen = settle_table(chosen.join(side(weight), "group"), "weighed")
        large = chosen.where("cells > 1")
        before, elements = large.agg(F.count("*"), F.sum("n")).first()
        if before:
            held = texts.select("row", "text").join(side(large.select("row", "group")), "row")
            shared = shared_elements(held.select("row", "group", "text"), elements, rule.words)
            kept = shared.join(large.select("row", "n"), "row").where(100 * F.col("shared") >= rule.percent * F.col("n"))
            left = side(kept.select("row"))
            before = before if left.count() < LEFT * before else 0
        done = chosen.where("cells = 1") if before else chosen
        found = done if found is None else found.union(done)
        if not before:
            return found


def links(texts: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """``a``, ``b``: vertices that are linked, enough to connect every group."""
    # One row for each vertex: equal sets are counted out on narrow rows, texts stay where they are.
    vertices = sets.where("n > 0").groupBy("vertex").agg(
        F.min("row").alias("row"), F.first("n").alias("n"), F.first("mark").alias("mark")
    )
    chosen = candidate_groups(texts, sets, vertices, rule)
    cell = F.pmod(F.xxhash64("vertex"), F.col("cells")).cast("int")
    dealt = settle_table(chosen.select("row", "vertex", "n", "group", "cells", cell.alias("cell")), "dealt")
    copies = dealt.agg(F.sum(F.col("n") * F.col("cells"))).first()[0] or 0
    whole = sets.agg(F.sum("n")).first()[0] or 0
    # A round sends about as many elements as all sets have, however many cells there are.
    rounds = max(1, math.ceil(copies / max(1, whole)))
    found = None
    for turn in range(rounds):
        # A set of cell c meets every other cell once, as (smaller, larger), both in the same round.
        met = F.filter(F.sequence(F.lit(0), F.col("cells") - 1), _of_round(turn, rounds))
        some = side(dealt.select("row", "vertex", "group", "cell", met.alias("others")).where(F.size("others") > 0))
        held = with_elements(texts.select("row", "text").join(some, "row"), rule)
        held = held.select("*", F.explode("others").alias("other"))
        pairs = held.select(
            "group", F.least("cell", "other").alias("i"), F.greatest("cell", "other").alias("j"), "vertex", "elements"
        )
        edges = settle_table(pairs.groupBy("group", "i", "j").applyInPandas(_checker(rule), "a binary, b binary"), "links")
        found = edges if found is None else found.union(edges)
    return found


def _of_round(turn: int, rounds: int):
    return lambda other: F.pmod(other + F.col("cell"), F.lit(rounds)) == turn


def _checker(rule: Rule):
    return lambda frame: _check(frame, rule)


def classes(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """Per row: ``row``, ``doc_id``, ``n`` and ``component_id``, the smallest id that can be reached
    by links."""
    return _classes(with_rows(docs), F.col("doc.doc_id"), words, percent)


def _classes(whole: DataFrame, name: Column, words: int, percent: int) -> DataFrame:
    rule = Rule(words, percent)
    texts = whole.select("row", name.alias("doc_id"), F.col("doc.text").cast("string").alias("text"))
    sets = document_sets(texts, rule)
    roots = components(links(texts, sets, rule))
    rows = sets.select("row", "doc_id", "n", "vertex")
    first = rows.where("n > 0").groupBy("vertex").agg(F.min("doc_id").alias("low"))
    known = first.join(roots.withColumnRenamed("node", "vertex"), "vertex", "left")
    known = known.select("vertex", "low", F.coalesce("root", "vertex").alias("root"))
    lowest = known.groupBy("root").agg(F.min("low").alias("component_id"))
    named = settle_table(known.join(lowest, "root").select("vertex", "component_id"), "named")
    found = rows.where("n > 0").join(named, "vertex").select("row", "doc_id", "n", "component_id")
    return found.union(rows.where("n = 0").select("row", "doc_id", "n", F.col("doc_id").alias("component_id")))


def deduplicate(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of linked documents, the first by file and place; rows without
    words all stay."""
    whole = with_rows(docs)
    found = _classes(whole, F.col("row"), words, percent)
    gone = found.where("n > 0 and doc_id != component_id").select(F.col("doc_id").alias("row"))
    return whole.join(side(gone), "row", "left_anti").select("doc.*")

"""Stretches of words that repeat at once: all maximal periodic runs, from an enhanced suffix
array.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are equal) that no
neighbouring word extends.  Its last two periods are a *branching tandem*: suffixes ``i`` and
``i + q`` that agree in exactly ``q`` words.  All of them are found from the suffix array, the
table of longest common prefixes (LCP) and the ranks of suffixes (ISA):

1. Suffixes are sorted by doubling; the ranks after each doubling are kept, so that any two
   places can be compared over ``2**k`` words at once.
2. Each boundary of the LCP table cuts its interval, up to the next smaller values on both
   sides, in two children.  For every suffix ``i`` of the smaller child and the boundary's
   depth ``d``, the ranks ``ISA[i + d]`` and ``ISA[i - d]`` are tested for membership in the other
   child.  Intervals are pairs of numbers; no tree is built.
3. Tandems are rotated to the left as far as words agree, by the ranks of step 1.  Tandems
   that end and begin together are one run, whose period is the smallest of theirs.

All texts of a batch go through these steps together as arrays; a word's first rank holds
its document, so suffixes of two documents never agree.  Tasks need no other rows: there is no
shuffle.  A batch holds texts of some bytes or one text; a very long text takes about 150
bytes of memory a word.

Words stand between white space and are known by 64-bit hashes.  Defined cases: a null or empty
text has no words and no runs; repeated rows are separate rows; an empty table gives no rows;
only the column ``text`` and what is carried along are read, other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyport.llm.words import BLANK_WORDS, Words, find_words, pieces, text_bytes

#: Bytes of text of one batch.
BATCH = 1_000_000
#: Tests of ISA that are made at once.
TESTS = 1 << 20


@dataclass(frozen=True)
class Rule:
    """Runs that count: at least ``least`` words and ``periods`` times the period."""

    least: int = 6
    periods: int = 4


class Suffixes:
    """Sorted suffixes of the words of several documents."""

    def __init__(self, words: np.ndarray, row: np.ndarray):
        """``words`` are any numbers; ``row`` is the document of each, ascending."""
        n = len(words)
        self.n, self.row = n, row
        order = np.lexsort((words, row))
        new = np.ones(n, bool)
        new[1:] = (words[order][1:] != words[order][:-1]) | (row[order][1:] != row[order][:-1])
        rank = np.empty(n, np.int32)
        # Ranks are the places of the first suffix of each group, so a group that is split keeps its room.
        rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
        self.levels = [rank]
        width = 1
        open_ = self._shared(new, order)
        while len(open_):
            rank = rank.copy()
            after = open_ + width
            inside = after < n
            inside[inside] = row[after[inside]] == row[open_[inside]]
            then = np.full(len(open_), -1, np.int64)
            then[inside] = self.levels[-1][after[inside]]
            key = (self.levels[-1][open_].astype(np.int64) << 32) + then + 1
            order = np.argsort(key, kind="stable")
            key, open_ = key[order], open_[order]
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            group = key >> 32
            head = np.ones(len(key), bool)
            head[1:] = group[1:] != group[:-1]
            at = np.arange(len(key))
            begin = np.maximum.accumulate(np.where(head, at, 0))
            rank[open_] = group + np.maximum.accumulate(np.where(new, at, 0)) - begin
            self.levels.append(rank)
            open_ = self._shared(new, open_)
            width *= 2
        self.rank = rank
        self.order = np.empty(n, np.int64)
        self.order[rank] = np.arange(n)

    @staticmethod
    def _shared(new: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Suffixes whose rank is not theirs alone, in order."""
        alone = new & np.append(new[1:], True)
        return order[~alone]

    def common(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many words agree from the places ``left`` and ``right`` on."""
        length = np.zeros(len(left), np.int64)
        live = np.arange(len(left))
        for k in range(len(self.levels) - 1, -1, -1):
            a, b = left[live] + length[live], right[live] + length[live]
            fits = np.maximum(a, b) < self.n
            same = np.zeros(len(live), bool)
            same[fits] = self.levels[k][a[fits]] == self.levels[k][b[fits]]
            length[live[same]] += 1 << k
        return length

    def common_before(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many words agree just before the places ``left`` and ``right``."""
        length = np.zeros(len(left), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            a, b = left - length - (1 << k), right - length - (1 << k)
            fits = np.minimum(a, b) >= 0
            same = np.zeros(len(left), bool)
            same[fits] = self.levels[k][a[fits]] == self.levels[k][b[fits]]
            length[same] += 1 << k
        return length

    def prefixes(self) -> np.ndarray:
        """The LCP table: words that a suffix shares with the one before it in order."""
        table = np.zeros(self.n, np.int64)
        first = self.levels[0]
        left, right = self.order[:-1], self.order[1:]
        some = np.flatnonzero(first[left] == first[right])
        table[some + 1] = self.common(left[some], right[some])
        return table


def _next_smaller(values: np.ndarray, or_equal: bool) -> np.ndarray:
    """For each place the next one with a smaller value (or an equal one), or the end.

    Everything between a place and where it points is at least as large, so pointers are
    followed until they point at what is sought.
    """
    n = len(values)
    ending = np.append(values, -1)
    at = np.append(np.arange(1, n + 1), n)
    live = np.arange(n)
    while len(live):
        there = ending[at[live]]
        on = there > ending[live] if or_equal else there >= ending[live]
        live = live[on]
        at[live] = at[at[live]]
    return at[:n]


def tandems(suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """Begin and period of all branching tandems."""
    table = suffixes.prefixes()
    n = suffixes.n
    after = _next_smaller(table, False)
    before = n - 1 - _next_smaller(table[::-1], True)[::-1]
    # Boundary j parts the suffixes of the ranks before[j] to j - 1 from those of j to after[j] - 1.
    edge = np.flatnonzero(table > 0)
    low, high = np.maximum(before[edge], 0), after[edge]
    first = edge - low <= high - edge
    size = np.where(first, edge - low, high - edge)
    begins, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    # Each slice holds at most TESTS suffixes, or the one child that is larger.
    ends = np.cumsum(size)
    cut = 0
    while cut < len(edge):
        done = int(ends[cut - 1]) if cut else 0
        stop = max(cut + 1, int(np.searchsorted(ends, done + TESTS, "right")))
        part = slice(cut, stop)
        of = np.repeat(np.arange(cut, stop), size[part])
        start = np.where(first[part], low[part], edge[part])
        place = np.arange(len(of)) - np.repeat(ends[part] - size[part] - done, size[part]) + np.repeat(start, size[part])
        i, d = suffixes.order[place], table[edge][of]
        other_low = np.where(first[of], edge[of], low[of])
        other_high = np.where(first[of], high[of], edge[of])
        for sign in (1, -1):
            j = i + sign * d
            fits = (j >= 0) & (j < n)
            seat = suffixes.rank[j[fits]]
            hit = np.flatnonzero(fits)[(seat >= other_low[fits]) & (seat < other_high[fits])]
            begins.append(np.minimum(i[hit], j[hit]))
            periods.append(d[hit])
        cut = stop
    return np.concatenate(begins), np.concatenate(periods)


def periodic_runs(words: np.ndarray, row: np.ndarray, rule: Rule) -> tuple[np.ndarray, ...]:
    """``start``, ``length`` and ``period`` of all runs that ``rule`` counts, by start and
    period; starts are places in ``words``."""
    if not len(words):
        return (np.zeros(0, np.int64),) * 3
    suffixes = Suffixes(words, row)
    begin, period = tandems(suffixes)
    start = begin - suffixes.common_before(begin, begin + period)
    end = begin + 2 * period
    # Of equal stretches the smallest period counts.
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    keep = np.ones(len(start), bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    length = end - start
    keep &= (length >= rule.least) & (length >= rule.periods * period)
    start, length, period = start[keep], length[keep], period[keep]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def kept_words(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Flags of the words that no run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change[:-1]) == 0


def _collapsed(data: np.ndarray, words: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept words of each row joined by one blank: bytes, and where rows begin."""
    row = words.rows()[keep]
    starts, sizes = words.starts[keep], (words.ends - words.starts)[keep]
    last = np.ones(len(row), bool)
    last[:-1] = row[1:] != row[:-1]
    room = sizes + ~last
    ends = np.cumsum(room)
    out = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
    inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[inside + np.repeat(ends - room, sizes)] = data[inside + np.repeat(starts, sizes)]
    ends = np.concatenate([[0], ends])
    return out, ends[np.searchsorted(row, np.arange(len(words.first)))]


def _runs(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", BATCH):
        data, offsets = text_bytes(batch.column("text"))
        words = find_words(data, offsets, BLANK_WORDS)
        row = words.rows()
        start, length, period = periodic_runs(words.hashes, row, rule)
        keep = kept_words(len(row), start, length, period)
        text, cuts = _collapsed(data, words, keep)
        columns = [pa.array(v) for v in (start - words.first[row[start]], length, period)]
        runs = pa.StructArray.from_arrays(columns, ["start", "length", "period"])
        edges = np.searchsorted(row[start], np.arange(batch.num_rows + 1)).astype(np.int32)
        joined = pa.Array.from_buffers(
            pa.string(), batch.num_rows, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(text.tobytes())]
        )
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("carried"),
                pa.array(words.counts),
                pa.ListArray.from_arrays(pa.array(edges), runs),
                joined,
            ],
            names=["carried", "n_words", "runs", "collapsed"],
        )


def find_runs(docs: DataFrame, carried: Column, rule: Rule = Rule()) -> DataFrame:
    """Per row ``carried``, ``n_words``, ``runs`` (``start``, ``length``, ``period`` in words, by
    start and period) and ``collapsed``, the words that repeat no earlier period of a run."""
    narrow = docs.select(carried.alias("carried"), F.col("text").cast("string").alias("text"))
    kind = narrow.schema["carried"].dataType.simpleString()
    return narrow.mapInArrow(
        lambda it: _runs(it, rule),
        f"carried {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string",
    )

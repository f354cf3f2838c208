"""Dropping repeated lines by a deletion-neighbourhood join.

Lines are compared word by word.  Two lines are alike if they hold the same words, or if
both have at least ``least`` words and one edit (a word replaced, added or left out) makes one
the other.  A line that is like an earlier line, in the order of files and places, is dropped; the
earliest stays.

Every line emits its whole and, if it is long enough, each variant with one word deleted, as
64-bit keys.  Equal variants are joined: two lines with the same variant and the same deleted place
differ by one replaced word, and a variant that is another line's whole is one added word.
So the edit distance is settled by key, place and length together; variants that agree at
different places (a word moved) are not alike.

Keys travel packed by batch and range of the key space, in one shuffle.  Of equal lines of a
batch only the first emits, so a line on every document costs one line per batch.  Tasks
return numbers of dropped lines by batch, never pairs.

Defined cases: lines end at a line feed, blanks around and between words do not count; a line without
words always stays; a null text has no lines, an empty one has one; repeated rows are later
documents, so all their lines drop; ids play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.llm.order import FILE_BITS, with_rows
from tallyport.llm.words import BLANK_WORDS, find_words, mixed, pieces, powers, text_bytes
from tallyport.runtime import default_partitions

#: One edit among fewer words leaves less than four fifths of them alike.
LEAST = 5
#: Bytes of text for each bucket of keys: some two million keys.
BUCKET_TEXT = 16_000_000
_LENGTH = np.uint64(0xD6E8FEB86659FD93)
# Places of a whole line; of one too short to have variants.  Packed in fewer bytes they are the
# two largest numbers of that width too.
_WHOLE, _SHORT = (1 << 32) - 1, (1 << 32) - 2
_PLACES = {1: np.uint8, 2: np.uint16, 4: np.uint32}


def line_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of a batch; of each line with words, where it begins among them, its row
    and number; and the lines of each row."""
    data, offsets = text_bytes(column)
    words = find_words(data, offsets, BLANK_WORDS)
    feeds = np.concatenate([[0], np.cumsum(data == 10)])
    row = words.rows()
    number = feeds[words.starts] - feeds[offsets[row]]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (number[1:] != number[:-1])
    first = np.flatnonzero(new)
    count = feeds[offsets[1:]] - feeds[offsets[:-1]] + 1
    count[column.is_null().to_numpy(zero_copy_only=False)] = 0
    return words.hashes, first, row[first], number[first], count


def variants(hashes: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Keys of all wholes and deletion variants, their place and their line; the wholes
    come first, in the order of lines."""
    size = np.diff(np.append(first, len(hashes)))
    line = np.repeat(np.arange(len(first)), size)
    place = np.arange(len(hashes)) - first[line]
    up, down = powers(max(1 << 12, int(size.max(initial=0)) + 1))
    terms = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[place])])
    total = terms[first + size] - terms[first]
    wholes = mixed(total + size.astype(np.uint64) * _LENGTH)
    at = np.flatnonzero((size >= least)[line])
    of = line[at]
    before = terms[at] - terms[first[of]]
    after = terms[(first + size)[of]] - terms[at + 1]
    rests = mixed(before + after * down[1] + (size[of] - 1).astype(np.uint64) * _LENGTH)
    kind = np.where(size >= least, _WHOLE, _SHORT)
    return (
        np.concatenate([wholes, rests]),
        np.concatenate([kind, place[at]]).astype(np.uint32),
        np.concatenate([np.arange(len(first)), of]).astype(np.uint32),
    )


def _seven(keys: np.ndarray) -> bytes:
    """Sorted keys as steps of seven bytes each, or of eight where a step needs it."""
    steps = np.diff(keys, prepend=np.uint64(0))
    wide = 8 if len(steps) and int(steps[1:].max(initial=0)) >> 56 else 7
    steps[:1] = 0
    flat = steps.view(np.uint8).reshape(-1, 8)[:, :wide]
    return np.array([wide, int(keys[0])], np.uint64).tobytes() + np.ascontiguousarray(flat).tobytes()


def _unseven(raw: memoryview, count: int) -> tuple[np.ndarray, int]:
    wide, start = np.frombuffer(raw, np.uint64, 2).tolist()
    steps = np.zeros((count, 8), np.uint8)
    steps[:, :wide] = np.frombuffer(raw, np.uint8, count * wide, 16).reshape(count, wide)
    steps = steps.reshape(-1).view(np.uint64)
    steps[0] = start
    return np.cumsum(steps), 16 + count * wide


def _by_file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut batches where the file changes, so that each holds neighbouring rows."""
    for batch in batches:
        file = batch.column("row").to_numpy() >> FILE_BITS
        cuts = [0, *(np.flatnonzero(np.diff(file)) + 1).tolist(), batch.num_rows]
        for at, end in zip(cuts, cuts[1:], strict=False):
            if end > at:
                yield batch.slice(at, end - at)


def _post(batches: Iterator[pa.RecordBatch], least: int, buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in pieces(_by_file(batches), "text", 4_000_000):
        rows = batch.column("row").to_numpy()
        hashes, first, of, number, count = line_words(batch.column("text"))
        keys, place, line = variants(hashes, first, least)
        # The first line of each content speaks for its batch.
        _, lead, same = np.unique(keys[: len(first)], return_index=True, return_inverse=True)
        repeated = lead[same] != np.arange(len(first))
        keep = ~repeated[line]
        keys, place, line = keys[keep], place[keep], line[keep]
        order = np.argsort(keys, kind="stable")
        keys, place, line = keys[order], place[order], line[order]
        bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        filled = np.flatnonzero(np.diff(cuts))
        packed = []
        for i in filled:
            part = slice(cuts[i], cuts[i + 1])
            code = line[part].astype(np.uint16) if len(first) < 1 << 16 else line[part]
            spot = place[part]
            last = int(spot[spot < _SHORT].max(initial=0))
            small = spot.astype(_PLACES[1 if last < 254 else 2 if last < 65534 else 4])
            head = np.array([len(code), code.itemsize, small.itemsize], np.int64).tobytes()
            packed.append(head + _seven(keys[part]) + code.tobytes() + small.tobytes())
        # The lines of the batch, for the task that puts its results together.
        book = np.concatenate([[len(rows), len(first)], rows, count, of, number]).astype(np.int64).tobytes()
        base = int(rows[0])
        dropped = np.flatnonzero(repeated).astype(np.uint32).tobytes()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*filled.tolist(), base % buckets], pa.int64()),
                pa.array([base] * (len(packed) + 1), pa.int64()),
                pa.array([*packed, dropped], pa.binary()),
                pa.array([None] * len(packed) + [book], pa.binary()),
            ],
            names=["bucket", "base", "packed", "book"],
        )


def _lowest(groups: np.ndarray, ranks: np.ndarray, total: int) -> np.ndarray:
    out = np.full(total, np.iinfo(np.int64).max)
    np.minimum.at(out, groups, ranks)
    return out


def _match(frame: pd.DataFrame) -> pd.DataFrame:
    """Numbers of the lines of each batch that are like an earlier line."""
    own = frame["book"].isna()
    frame = frame.sort_values("base")
    keys, codes, places, blob = [], [], [], []
    bases = []
    for base, raw in zip(frame["base"][own], frame["packed"][own]):
        count, code_width, place_width = np.frombuffer(raw, np.int64, 3).tolist()
        key, used = _unseven(memoryview(raw)[24:], count)
        at = 24 + used
        code = np.frombuffer(raw, np.uint16 if code_width == 2 else np.uint32, count, at)
        small = np.frombuffer(raw, _PLACES[place_width], count, at + count * code_width)
        place = small.astype(np.uint32)
        if place_width < 4:
            above = 1 << 8 * place_width
            place[small >= above - 2] += np.uint32((1 << 32) - above)
        keys.append(key), codes.append(code.astype(np.int64)), places.append(place)
        blob.append(np.full(count, len(bases)))
        bases.append(base)
    rest = frame.loc[~own, ["base", "packed", "book"]]
    if not keys:
        return rest
    keys = np.concatenate(keys)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    shared = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    order, ranked = order[shared], ranked[shared]
    if not len(order):
        return rest
    code = np.concatenate(codes)[order]
    place = np.concatenate(places)[order]
    batch = np.concatenate(blob)[order]
    rank = (batch << 32) | code  # blobs stand in the order of their base
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    group = np.cumsum(new) - 1
    total = int(group[-1]) + 1
    whole, short = place == _WHOLE, place == _SHORT
    loose = ~whole & ~short
    first_whole = _lowest(group[whole], rank[whole], total)
    first_loose = _lowest(group[loose], rank[loose], total)
    first_short = _lowest(group[short], rank[short], total)
    spots, spot = np.unique((group << 32) | place.astype(np.int64), return_inverse=True)
    first_spot = _lowest(spot, rank, len(spots))
    earliest = np.where(
        short, first_short[group],
        np.where(whole, np.minimum(first_whole, first_loose)[group], np.minimum(first_spot[spot], first_whole[group])),
    )
    hit = earliest < rank
    batch, code = batch[hit], code[hit]
    found = [(bases[b], np.unique(code[batch == b]).astype(np.uint32).tobytes(), None) for b in np.unique(batch)]
    return pd.concat([pd.DataFrame(found, columns=["base", "packed", "book"]), rest])


def _gather(frame: pd.DataFrame) -> pd.DataFrame:
    """Per row of a batch its number of lines and the numbers of those dropped."""
    book = np.frombuffer(frame["book"][frame["book"].notna()].iloc[0], np.int64)
    rows, lines = book[:2].tolist()
    row, count, of, number = np.split(book[2:], np.cumsum([rows, rows, lines]))
    codes = np.unique(np.concatenate([np.frombuffer(p, np.uint32) for p in frame["packed"]]))
    dropped = np.split(number[codes], np.searchsorted(of[codes], np.arange(1, rows)))
    return pd.DataFrame({"row": row, "n_lines": count, "dropped": dropped})


def repeated_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Per row: ``row`` (its number by :func:`~tallyport.llm.order.with_rows`), ``n_lines`` and
    ``dropped``, the numbers from 0 of the lines like an earlier one."""
    narrow = with_rows(docs).select("row", F.col("doc.text").cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(default_partitions(docs.sparkSession), math.ceil(size / BUCKET_TEXT))
    posted = narrow.mapInArrow(
        lambda it: _post(it, least, buckets), "bucket long, base long, packed binary, book binary"
    )
    matched = posted.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(
        _match, "base long, packed binary, book binary"
    )
    return matched.groupBy("base").applyInPandas(_gather, "row long, n_lines long, dropped array<long>")


def without_lines(text: str, dropped: list[int]) -> str:
    """A text without the given lines."""
    gone = set(dropped)
    return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)

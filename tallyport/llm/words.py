"""Words of Arrow text columns as 64-bit hashes, found on the UTF-8 bytes.

Everything is vectorised over the bytes of a whole batch and works in windows of a few
hundred kilobytes, so that temporary arrays stay small however long a text is.  A byte of
128 or more belongs to a character outside ASCII; all word classes used here hold all of
those or none, so a word never cuts a character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

WINDOW = 1 << 18
_FACTOR = 0x9E3779B97F4A7C55  # odd, so that its powers can be inverted modulo 2**64
_ALL = (1 << 64) - 1


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags that is true inside the given closed ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Words between white space: ``[^\x20\x09-\x0D]+``.
BLANK_WORDS = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Lower-cased alphanumeric words: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
PLAIN_WORDS = ~byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` neighbouring values of ``h``."""
    out = h[: max(0, len(h) - n + 1)].copy()
    for i in range(1, n):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + np.uint64(i)) ^ h[i : i + len(out)]
    return mixed(out)


_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the factor and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        _powers.clear()
        for base in (_FACTOR, pow(_FACTOR, -1, 1 << 64)):
            table = np.full(n, base & _ALL, np.uint64)
            table[0] = 1
            _powers.append(np.multiply.accumulate(table))
    return _powers[0], _powers[1]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; a null has no bytes."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count and np.any(np.diff(offsets)[column.is_null().to_numpy(zero_copy_only=False)]):
        return text_bytes(column.fill_null(""))
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Word positions of a batch: ``first[i]:first[i + 1]`` are the words of row ``i``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray | None

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def windows(data: np.ndarray, word: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut ``data`` where no word is cut."""
    at = 0
    while at < len(data):
        end = min(len(data), at + WINDOW)
        while end < len(data) and word[data[end]] and word[data[end - 1]]:
            step = data[end : end + 4096]
            gap = np.flatnonzero(~word[step])
            row = bounds[np.searchsorted(bounds, end)]
            end = min(end + (int(gap[0]) if len(gap) else len(step)), int(row))
            if len(gap) or end == row:
                break
        yield at, end
        at = end


def find_words(
    data: np.ndarray,
    offsets: np.ndarray,
    word: np.ndarray,
    lower: bool = False,
    hashed: bool = True,
    kinds: np.ndarray | None = None,
) -> Words:
    """All words of a batch.

    ``word`` flags the bytes of words.  With ``kinds``, a table of small numbers, a word
    also ends where the kind of its bytes changes.
    """
    starts, ends, hashes = [], [], []
    for low, high in windows(data, word, offsets):
        part = data[low:high]
        inside = word[part]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        if kinds is not None:
            kind = kinds[part]
            first[1:] |= inside[1:] & (kind[1:] != kind[:-1])
        cuts = offsets[np.searchsorted(offsets, low) : np.searchsorted(offsets, high)] - low
        first[cuts] = inside[cuts]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | first[1:]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        starts.append(s + low)
        ends.append(e + low)
        if hashed:
            up, down = powers(max(WINDOW + 8192, high - low + 1))
            letters = (LOWER[part] if lower else part).astype(np.uint64)
            letters += np.uint64(1)
            letters *= up[: len(part)]
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(letters, out=total[1:])
            hashes.append(mixed((total[e] - total[s]) * down[s]))
    s = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    e = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    h = (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)) if hashed else None
    return Words(s, e, np.searchsorted(s, offsets), h)


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each hold about ``most`` bytes, or are one row."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end

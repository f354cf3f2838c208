"""Personal data by bootstrapped contextual extraction.

``scan`` reads every text once.  It finds the base spans (mail addresses, IPv4 addresses,
card and phone numbers with their checks) and the candidate tokens: words with a digit or
an ``@``, where neighbouring words that blanks alone part and that are parts of one number, as
cards and phones are written, make one token, up to the digits that such a number has.  A
token is an instance; its patterns are the word before it, the two words before it, the word
after it, and the words on both sides, each with the classes of signs its (first) word is made
of.  Tokens that overlap base spans are the seeds.

``good_patterns`` scores the graph of patterns and instances in rounds of Spark
aggregations: a pattern's confidence in a kind is the share of its occurrences whose instances
are of that kind, an unknown instance's score is the noisy-or of its patterns' confidence.  Patterns with
enough different instances and a high confidence then mark the tokens in their place that
no base span covers.

Defined cases: a null or empty text has no spans; repeated rows are separate; ids may be
null.  Spans are code points, end exclusive; found spans of one kind may not overlap base spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyport.llm.words import BLANK_WORDS, byte_class, find_words, mixed, pieces, text_bytes
from tallyport.runtime import settle, settle_table

KINDS = ("email", "ip", "card", "phone")
SUPPORT = 5
CONFIDENCE = 0.9
ROUNDS = 3

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits begins, and takes whole runs.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_SIGNS:
            start -= 1
        end = at + 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end
        done = end
        at = text.find("@", end)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind number, start and end of all base spans."""
    out = [(0, s, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((3, *m.span()))
    return out


_DIGIT = byte_class((48, 57))
_MARKED = _DIGIT | byte_class((64, 64))
#: Classes of signs of a token, one bit each.
_SIGNS = np.zeros(256, np.int64)
_SIGNS[128:] = 1
_SIGNS[[*range(65, 91), *range(97, 123)]] = 1
_SIGNS[48:58] = 2
for _bit, _sign in enumerate(b"@.-+/:=_", 2):
    _SIGNS[_sign] = 1 << _bit
_EDGE = b"\"'`.,;:!?()[]{}<>=*#|&$"


#: What a number that goes on over blanks is made of; a plus sign begins another number.
_PARTS = b"0123456789().-"
_FIGURE = re.compile(rb"[0-9]")
_LETTER = re.compile(rb"[A-Za-z@\x80-\xff]")


#: The most digits of a number: of one with a plus sign before it, and of any other.
_MOST_PHONE, _MOST_DIGITS = 15, 19


def _goes_on(word: bytes) -> bool:
    """Whether a word ends in a part of a number, by itself or after a sign such as a colon.
    Parts hold one dot at most: an address is whole."""
    before = word.rstrip(_PARTS)
    part = word[len(before) :]
    whole = not _FIGURE.search(part) or part.strip(b".").count(b".") > 1
    return not whole and not _LETTER.match(before[-1:]) and b"@" not in before


def _joins(word: bytes) -> bool:
    """Whether a word is a part of a number, but for signs after it."""
    after = word.lstrip(_PARTS)
    part = word[: len(word) - len(after)]
    return bool(_FIGURE.search(part)) and part.strip(b".").count(b".") < 2 and not after.strip(_EDGE)


def _digits(word: bytes) -> int:
    return len(_FIGURE.findall(word))


def _last_part(raw: bytes, starts: np.ndarray, ends: np.ndarray, i: int) -> int:
    """The last word of the number that begins in word ``i``: parts are taken as long as the number
    has no more digits than its kind."""
    last = i
    first = raw[starts[i] : ends[i]]
    part = first[len(first.rstrip(_PARTS)) :]
    plus = first[: len(first) - len(part)].endswith(b"+")
    held, most = _digits(part), _MOST_PHONE if plus else _MOST_DIGITS
    while _goes_on(raw[starts[last] : ends[last]]):
        k, at = last + 1, ends[last]
        # Signs between blanks belong to the number if another part follows.
        while k < len(starts) and not raw[at : starts[k]].strip(b" ") and not raw[starts[k] : ends[k]].strip(b"().-"):
            k, at = k + 1, ends[k]
        if k == len(starts) or raw[at : starts[k]].strip(b" ") or not _joins(raw[starts[k] : ends[k]]):
            break
        held += _digits(raw[starts[k] : ends[k]])
        if held > most:
            break
        last = k
    return last


def _candidates(text: str, raw: bytes, spans: list[tuple[int, int, int]]) -> list[dict]:
    """Tokens with a digit or ``@``, their patterns, and the kind of a base span they meet; the
    words of one number are one token."""
    data = np.frombuffer(raw, np.uint8)
    words = find_words(data, np.array([0, len(data)]), BLANK_WORDS, lower=True)
    marked = np.concatenate([[0], np.cumsum(_MARKED[data])])
    point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    out, last = [], -1
    # Spans in the order of their start; those that may still meet a token are open.
    waiting, open_ = sorted(spans, key=lambda s: s[1], reverse=True), []
    for i in np.flatnonzero(marked[words.ends] > marked[words.starts]).tolist():
        if i <= last:
            continue
        last = _last_part(raw, words.starts, words.ends, i)
        start, end = int(words.starts[i]), int(words.ends[i])
        while start < end and raw[start] in _EDGE:
            start += 1
        while end > start and raw[end - 1] in _EDGE:
            end -= 1
        if start == end:
            continue
        signs = int(np.bitwise_or.reduce(_SIGNS[data[start:end]]))
        left, further, right = (int(words.hashes[j]) if 0 <= j < len(words.hashes) else 0 for j in (i - 1, i - 2, last + 1))
        places = [left ^ signs, left * 3 + further * 5 + signs + 1, right * 7 + signs + 2, left * 11 + right * 13 + signs + 3]
        patterns = mixed(np.array([p & ((1 << 64) - 1) for p in places], np.uint64)).view(np.int64)
        instance = words.hashes[i : i + 1]
        if last > i:
            end = int(words.ends[last])
            while raw[end - 1] in _EDGE:
                end -= 1
            for j in range(i + 1, last + 1):
                instance = mixed(instance * np.uint64(0x9E3779B97F4A7C15)) ^ words.hashes[j]
        first, final = int(point[start]), int(point[end])
        while waiting and waiting[-1][1] < final:
            open_.append(waiting.pop())
        open_ = [s for s in open_ if s[2] > first]
        kind = min((k for k, s, e in open_ if s < final), default=-1)
        out.append(
            {"kind": kind, "start": first, "end": final, "instance": int(instance.view(np.int64)[0]),
             "patterns": patterns.tolist()}
        )
    return out


_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
_TOKEN = pa.struct(
    [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("instance", pa.int64()), ("patterns", pa.list_(pa.int64()))]
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        column = batch.column("text")
        data, offsets = text_bytes(column)
        marks = np.concatenate([[0], np.cumsum(_MARKED[data])])
        spans, tokens = [[]] * batch.num_rows, [[]] * batch.num_rows
        for i in np.flatnonzero(marks[offsets[1:]] > marks[offsets[:-1]]).tolist():
            raw = data[offsets[i] : offsets[i + 1]].tobytes()
            text = raw.decode("utf-8")
            found = base_spans(text)
            spans[i] = [{"kind": k, "start": s, "end": e} for k, s, e in sorted(found)]
            tokens[i] = _candidates(text, raw, found)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), pa.array(spans, pa.list_(_SPAN)), pa.array(tokens, pa.list_(_TOKEN))],
            names=["row", "doc_id", "spans", "tokens"],
        )


def scan(docs: DataFrame) -> DataFrame:
    """Per row ``row, doc_id, spans`` (base) and ``tokens`` (candidates), written to the shared
    folder."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id"), F.col("text").cast("string").alias("text")
    )
    schema = (
        f"row long, doc_id {kind}, spans array<struct<kind: int, start: int, end: int>>, "
        "tokens array<struct<kind: int, start: int, end: int, instance: long, patterns: array<long>>>"
    )
    return settle_table(narrow.mapInArrow(_scan, schema), "spans")


def good_patterns(
    scanned: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, rounds: int = ROUNDS
) -> DataFrame:
    """``pattern`` and ``kind`` of the patterns that passed the last round.

    Occurrences are counted by pattern and instance before anything else; all that follows
    joins and sums that table.
    """
    token = scanned.select(F.explode("tokens").alias("t"))
    flat = token.select(F.explode("t.patterns").alias("pattern"), "t.instance", "t.kind")
    edges = settle(flat.groupBy("pattern", "instance", "kind").agg(F.count("*").alias("n")))
    totals = edges.groupBy("pattern").agg(F.sum("n").alias("total"))
    seeds = edges.where("kind >= 0").select("pattern", "instance", "kind", "n", F.lit(1.0).alias("score"))
    unknown = edges.where("kind < 0").select("pattern", "instance", "n")
    known = None
    for _ in range(rounds):
        votes = seeds
        if known is not None:
            votes = votes.unionByName(unknown.join(known, "instance").select("pattern", "instance", "kind", "n", "score"))
        mass = votes.groupBy("pattern", "kind").agg(
            F.sum(F.col("n") * F.col("score")).alias("mass"), F.count("*").alias("different")
        )
        sure = F.col("mass") / F.col("total")
        chosen = mass.join(totals, "pattern").select("pattern", "kind", "different", sure.alias("sure"))
        chosen = settle(chosen.where((F.col("different") >= support) & (F.col("sure") >= confidence)))
        missed = F.log(F.greatest(1 - F.col("sure"), F.lit(1e-6)))
        score = (1 - F.exp(F.sum(missed))).alias("score")
        known = unknown.join(chosen, "pattern").groupBy("instance", "kind").agg(score)
        known = known.where(F.col("score") >= confidence)
    return chosen.select("pattern", "kind")


def find(docs: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """Per row ``row, doc_id, base`` and ``spans``: arrays of ``kind, start, end`` in order
    of kind and start; ``spans`` holds the base ones and those that patterns add."""
    scanned = scan(docs)
    patterns = good_patterns(scanned, support, confidence)
    loose = scanned.select("row", F.explode("tokens").alias("t")).where("t.kind < 0")
    placed = loose.select("row", "t.start", "t.end", F.explode("t.patterns").alias("pattern"))
    span = F.struct("kind", F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))
    added = placed.join(patterns, "pattern").groupBy("row").agg(F.collect_set(span).alias("added"))
    rows = scanned.select("row", "doc_id", F.col("spans").alias("base")).join(added, "row", "left")
    whole = F.concat("base", F.coalesce("added", F.array().cast("array<struct<kind:int,start:int,end:int>>")))
    return rows.select("row", "doc_id", "base", F.array_sort(whole).alias("spans"))


def as_text(spans: str) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ","
    )


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """A text with its spans replaced by their kind."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
            at = end
    return "".join([*out, text[at:]])

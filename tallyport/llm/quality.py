"""Quality classifier: logistic regression over hashed word n-grams, trained by FTRL-proximal.

A text is cut into tokens, runs of letters and digits or runs of other signs; a feature is
the hash of a run of one or two tokens (a token and itself are one feature, whatever the
token), its value ``log(1 + count)``, and the vector has length 1.  A score is the logistic
of a sparse dot product.

Training takes at most ``EXAMPLES`` labelled rows, those with the smallest hash of their id; a text of
any length counts whole.  The rows are dealt to ``SHARDS`` tasks.  In each round every task
runs follow-the-regularised-leader updates over its rows, starting from the shared state,
and the states are averaged (parameter mixing), slice by slice in tasks of their own, so that the
driver gets one state a round however many shards there are; rows of the rarer label weigh more.
Weights, 2**18 numbers, travel to the scoring tasks as a broadcast of fixed size.

Defined cases: a null or empty text has no features and gets the score of the bias alone; null labels
and ids teach nothing; several labels of an id are several examples, an id that is on several
documents teaches with one of them (the smallest hash of its features); without labels
every score is 0.5; repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyport.llm.words import BLANK_WORDS, find_words, mixed, pieces, text_bytes
from tallyport.runtime import settle_table

BITS = 18
EXAMPLES = 32_000
SHARDS = 4
#: Slices that the states of a round are averaged in.
SLICES = 64
ROUNDS = 4
#: Times a task goes over its rows in a round.
PASSES = 4
#: The rarer label weighs as much as the other in total, up to this factor a row.
MOST_WEIGHT = 8.0
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.05, 0.1

#: Letters, digits and everything outside ASCII against all other signs.
_KINDS = np.zeros(256, np.uint8)
_KINDS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
#: The pair of any token and itself.
_TWICE = np.uint64(0x9E3779B97F4A7C15)


def features(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and values of all rows, flat, and where each row begins."""
    data, offsets = text_bytes(column)
    words = find_words(data, offsets, BLANK_WORDS, kinds=_KINDS)
    rows = words.rows()
    pairs = mixed(words.hashes[:-1] * np.uint64(31) + words.hashes[1:]) if len(rows) else words.hashes
    if len(rows):
        pairs[words.hashes[:-1] == words.hashes[1:]] = _TWICE
    inside = rows[:-1] == rows[1:] if len(rows) else np.zeros(0, bool)
    bucket = np.concatenate([words.hashes, pairs[inside]]) >> np.uint64(64 - bits)
    owner = np.concatenate([rows, rows[:-1][inside]]) if len(rows) else rows
    keys = np.sort((owner.astype(np.uint64) << np.uint64(bits)) | bucket)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    begins = np.flatnonzero(new)
    value = np.log1p(np.diff(np.append(begins, len(keys)))).astype(np.float64)
    keys = keys[begins]
    row = (keys >> np.uint64(bits)).astype(np.int64)
    first = np.searchsorted(row, np.arange(len(offsets)))
    norm = np.sqrt(np.bincount(row, value * value, minlength=len(offsets) - 1))
    return (keys & np.uint64((1 << bits) - 1)).astype(np.int32), value / norm[row], first


def _vectors(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        bucket, value, first = features(batch.column("text"), bits)
        bounds = pa.py_buffer((first * 4).astype(np.int32))
        lists = [
            pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, bounds, pa.py_buffer(x.tobytes())])
            for x in (bucket, value.astype(np.float32))
        ]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], names=["doc_id", "buckets", "values"])


def examples(docs: DataFrame, labels: DataFrame, most: int = EXAMPLES, bits: int = BITS) -> DataFrame:
    """``label``, ``buckets``, ``values`` and ``draw`` of at most ``most`` labelled rows.

    ``labels`` has ``doc_id`` and ``label``; those with the smallest hash are drawn.
    """
    draw = F.xxhash64(F.col("doc_id").cast("string"), "label")
    chosen = labels.where("doc_id is not null and label is not null").select("doc_id", "label", draw.alias("draw"))
    chosen = settle_table(chosen.orderBy("draw", "doc_id").limit(most), "labels")
    # At most ``most`` rows, so a broadcast of bounded size.
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")
    kind = docs.schema["doc_id"].dataType.simpleString()
    vectors = texts.mapInArrow(lambda it: _vectors(it, bits), f"doc_id {kind}, buckets binary, values binary")
    one = vectors.groupBy("doc_id").agg(
        F.min_by(F.struct("buckets", "values"), F.xxhash64("buckets", "values")).alias("vector")
    )
    return settle_table(one.join(F.broadcast(chosen), "doc_id").select("label", "draw", "vector.*"), "examples")


class Ftrl:
    """State of follow-the-regularised-leader with per-coordinate rates; the last is the bias."""

    def __init__(self, z: np.ndarray, n: np.ndarray):
        self.z, self.n = z, n

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: float, weight: float) -> None:
        w = self.weights(at)
        g = weight * (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def _round(frame: pd.DataFrame, state: Broadcast, bits: int) -> pd.DataFrame:
    z, n, weight = state.value
    model = Ftrl(z.copy(), n.copy())
    frame = frame.sort_values("draw")
    for _ in range(PASSES):
        for row in frame.itertuples():
            at = np.append(np.frombuffer(row.buckets, np.int32), 1 << bits)
            x = np.append(np.frombuffer(row.values_, np.float32), 1.0).astype(np.float64)
            model.learn(at, x, float(row.label), weight[int(row.label > 0)])
    z, n = ([x.tobytes() for x in np.array_split(whole, SLICES)] for whole in (model.z, model.n))
    return pd.DataFrame({"slice": range(SLICES), "shard": frame["shard"].iloc[0], "z": z, "n": n})


def _mean(frame: pd.DataFrame) -> pd.DataFrame:
    """One slice of the state, averaged over the shards in their order."""
    frame = frame.sort_values("shard")
    z, n = (np.mean([np.frombuffer(x) for x in frame[c]], axis=0).tobytes() for c in ("z", "n"))
    return pd.DataFrame({"slice": frame["slice"].iloc[:1], "z": [z], "n": [n]})


def _learner(state: Broadcast, bits: int):
    return lambda frame: _round(frame, state, bits)


def train(rows: DataFrame, rounds: int = ROUNDS, shards: int = SHARDS, bits: int = BITS) -> np.ndarray:
    """Weights of all buckets and, last, of the bias."""
    spark = rows.sparkSession
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    dealt = rows.select(F.pmod("draw", F.lit(shards)).alias("shard"), "label", "draw", "buckets", F.col("values").alias("values_"))
    ones, count = rows.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("*")).first()
    odds = (count - ones) / ones if ones and count > ones else 1.0
    weight = (float(np.clip(1 / odds, 1, MOST_WEIGHT)), float(np.clip(odds, 1, MOST_WEIGHT)))
    for _ in range(rounds):
        state = spark.sparkContext.broadcast((z, n, weight))
        parts = dealt.groupBy("shard").applyInPandas(_learner(state, bits), "slice int, shard int, z binary, n binary")
        # One state of fixed size, in slices.
        found = sorted(parts.groupBy("slice").applyInPandas(_mean, "slice int, z binary, n binary").collect())
        if found:
            z = np.concatenate([np.frombuffer(r["z"]) for r in found])
            n = np.concatenate([np.frombuffer(r["n"]) for r in found])
        state.destroy()
    return Ftrl(z, n).weights()


def _logistic(column: pa.Array, w: np.ndarray, bits: int) -> np.ndarray:
    bucket, value, first = features(column, bits)
    total = np.concatenate([[0.0], np.cumsum(w[bucket] * value)])
    return 1 / (1 + np.exp(-(total[first[1:]] - total[first[:-1]] + w[-1])))


def _scores(batches: Iterator[pa.RecordBatch], weights: Broadcast, bits: int) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        score = _logistic(batch.column("text"), weights.value, bits)
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(score)], names=[*names, "score"])


def score(docs: DataFrame, weights: np.ndarray, carried: Column, bits: int = BITS) -> DataFrame:
    """``carried`` and ``score`` of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    narrow = docs.select(carried.alias("carried"), F.col("text").cast("string").alias("text"))
    kind = narrow.schema["carried"].dataType.simpleString()
    return narrow.mapInArrow(lambda it: _scores(it, sent, bits), f"carried {kind}, score double")


def remainder(divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(divisor))


def fit(docs: DataFrame, labels: DataFrame, most: int = EXAMPLES) -> np.ndarray:
    """Weights learned from ``labels.quality``, without the held-out quarter of the ids."""
    rows = labels.where(remainder(4) != 2).select("doc_id", F.col("quality").alias("label"))
    return train(examples(docs, rows, most))


def _good(batches: Iterator[pa.RecordBatch], weights: Broadcast, bits: int, least: float) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        yield batch.filter(pa.array(_logistic(batch.column("text"), weights.value, bits) >= least))


def keep_good(docs: DataFrame, weights: np.ndarray, least: float, bits: int = BITS) -> DataFrame:
    """The documents with a score of at least ``least``, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    return docs.mapInArrow(lambda it: _good(it, sent, bits, least), docs.schema)

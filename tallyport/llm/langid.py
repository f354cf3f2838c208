"""Language identification by the nearest of several centroids per language.

A text is seen as its lower-cased letters with one blank for any run of other ASCII signs;
its features are hashed runs of three bytes, weighted by TF-IDF and scaled to length 1.
Each language has up to ``CENTRES`` centroids, found by spherical k-means over a bounded sample
of its labelled texts.  A text gets the language of the centroid with the largest cosine, and
``und`` where even that is below ``reject`` (a distance above ``1 - reject``) or where there is no
letter at all.

Training takes at most ``EXAMPLES`` different texts of each language, those with the smallest
hash, each whole; they are counted and drawn over all rows, a text with copies once.  The centroids
(languages x ``CENTRES`` x 2**13 numbers) travel as a broadcast: their size does not grow
with the rows.

Defined cases: a null text, an empty one and one without letters are ``und`` with score 0;
null languages teach nothing; texts without letters teach nothing; without any labels
everything is ``und``; repeated rows are predicted each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyport.llm.order import side, with_rows
from tallyport.llm.words import LOWER, pieces, text_bytes
from tallyport.runtime import settle_table

BITS = 13
CENTRES = 4
EXAMPLES = 1500
ITERATIONS = 8
UNKNOWN = "und"

_SHOWN = LOWER.copy()
_SHOWN[[*range(0, 65), *range(91, 97), *range(123, 128)]] = 32


def has_letter(column: pa.Array) -> np.ndarray:
    """Whether each text holds a letter of any script."""
    data, offsets = text_bytes(column)
    shown = np.concatenate([[0], np.cumsum((_SHOWN[data] != 32) & (data < 128))])
    found = shown[offsets[1:]] > shown[offsets[:-1]]
    for i in np.flatnonzero(~found):
        if offsets[i + 1] > offsets[i]:
            found[i] = any(c.isalpha() for c in column[int(i)].as_py())
    return found


def vectors(column: pa.Array, bits: int = BITS) -> np.ndarray:
    """Hashed counts of three-byte runs, one dense row per text."""
    data, offsets = text_bytes(column)
    width = 1 << bits
    out = np.zeros((len(offsets) - 1, width), np.float32)
    for i in range(len(offsets) - 1):
        shown = _SHOWN[data[offsets[i] : offsets[i + 1]]]
        blank = shown == 32
        keep = ~blank
        keep[1:] |= ~blank[:-1]
        shown = shown[keep].astype(np.uint32)
        if len(shown) and not (len(shown) == 1 and shown[0] == 32):
            shown = np.concatenate([[32], shown, [32]]).astype(np.uint32)
            runs = (shown[:-2] << 16) | (shown[1:-1] << 8) | shown[2:]
            runs = (runs * np.uint32(2654435761)) >> np.uint32(32 - bits)
            out[i] = np.bincount(runs, minlength=width)
    return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length 1 (zero rows stay)."""
    rows = np.log1p(counts) * idf
    norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(norm > 0, norm, 1)


def _count_rows(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", 2_000_000):
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            letters = has_letter(part.column("text"))
            counts = vectors(part.column("text"), bits)
            pairs = [np.flatnonzero(row) if known else np.zeros(0, int) for row, known in zip(counts, letters, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("lang"),
                    pa.array([p.astype(np.int32) for p in pairs], pa.list_(pa.int32())),
                    pa.array([row[p] for row, p in zip(counts, pairs, strict=True)], pa.list_(pa.float32())),
                ],
                names=["lang", "buckets", "counts"],
            )


def examples(docs: DataFrame, most: int = EXAMPLES, bits: int = BITS) -> DataFrame:
    """``lang, buckets, counts`` of at most ``most`` different texts of each language of
    ``docs`` (``lang``, ``text``)."""
    known = with_rows(docs).where("doc.lang is not null and doc.text is not null").select(
        "row", F.col("doc.lang").cast("string").alias("lang"), F.col("doc.text").cast("string").alias("text")
    )
    # Copies are one text: they count once and are drawn once.
    different = known.select("row", "lang", F.xxhash64("text").alias("hash")).groupBy("lang", "hash")
    different = settle_table(different.agg(F.min("row").alias("row")), "different")
    # A first cut by a share of the hash range, so that no language is ranked whole.
    draw = F.pmod("hash", F.lit(1 << 40))
    sizes = different.groupBy("lang").agg(F.count("*").alias("texts"))
    share = F.least(F.lit(1.0), 1.5 * most / F.col("texts") + 50 / F.col("texts"))
    marked = different.withColumn("draw", draw).join(F.broadcast(sizes.select("lang", share.alias("share"))), "lang")
    few = marked.where(F.col("draw") < F.col("share") * (1 << 40))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "hash"))
    drawn = few.withColumn("rank", rank).where(F.col("rank") <= most).select("row")
    chosen = known.join(side(drawn), "row").select("lang", "text")
    rows = chosen.mapInArrow(lambda it: _count_rows(it, bits), "lang string, buckets array<int>, counts array<float>")
    return settle_table(rows.where(F.size("buckets") > 0), "languages")


def _dense(frame: pd.DataFrame, bits: int) -> np.ndarray:
    out = np.zeros((len(frame), 1 << bits), np.float32)
    for i, (at, count) in enumerate(zip(frame["buckets"], frame["counts"], strict=True)):
        out[i, np.asarray(at)] = np.asarray(count)
    return out


def cluster(rows: np.ndarray, centres: int, iterations: int = ITERATIONS) -> np.ndarray:
    """Spherical k-means; the first centroid is the mean, the next are the rows farthest
    from those so far."""
    def unit(x):
        norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
        return x / np.where(norm > 0, norm, 1)

    found = unit(rows.mean(axis=0, keepdims=True))
    while len(found) < min(centres, len(rows)):
        nearest = (rows @ found.T).max(axis=1)
        found = np.concatenate([found, rows[[int(nearest.argmin())]]])
    for _ in range(iterations):
        own = (rows @ found.T).argmax(axis=1)
        moved = [rows[own == k].mean(axis=0) if (own == k).any() else found[k] for k in range(len(found))]
        found = unit(np.stack(moved))
    return found.astype(np.float32)


def _fitter(idf: np.ndarray, centres: int, bits: int):
    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.iloc[np.lexsort((frame["counts"].map(lambda c: float(np.sum(c))), frame["buckets"].map(tuple)))]
        found = cluster(weighted(_dense(frame, bits), idf), centres)
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "centre": [c.tobytes() for c in found]})

    return fit


def train(rows: DataFrame, centres: int = CENTRES, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """``idf``, centroids and the language of each centroid."""
    total = rows.count()
    seen = rows.select(F.explode("buckets").alias("bucket")).groupBy("bucket").count().collect()
    idf = np.zeros(1 << bits, np.float32)
    for r in seen:  # at most 2 ** bits rows
        idf[r["bucket"]] = np.log((1 + total) / (1 + r["count"])) + 1
    # One task per language, each with a bounded sample.
    found = rows.groupBy("lang").applyInPandas(_fitter(idf, centres, bits), "lang string, centre binary")
    held = sorted((r["lang"], bytes(r["centre"])) for r in found.collect())
    table = np.array([np.frombuffer(c, np.float32) for _, c in held]).reshape(-1, 1 << bits)
    return idf, table, [lang for lang, _ in held]


def _predict(batches: Iterator[pa.RecordBatch], model: Broadcast, reject: float) -> Iterator[pa.RecordBatch]:
    idf, table, langs = model.value
    bits = len(idf).bit_length() - 1
    names = np.array([*langs, UNKNOWN], object)
    for batch in pieces(batches, "text", 2_000_000):
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            letters = has_letter(part.column("text"))
            if len(langs):
                cosine = weighted(vectors(part.column("text"), bits), idf) @ table.T
                best = cosine.argmax(axis=1)
                score = np.clip(cosine[np.arange(len(best)), best], 0, 1).astype(np.float64)
            else:
                best, score = np.zeros(part.num_rows, int), np.zeros(part.num_rows)
            known = letters & (score >= reject) & (len(langs) > 0)
            best = np.where(known, best, len(langs))
            score = np.where(letters, score, 0.0)
            carried = [part.column(n) for n in part.schema.names if n != "text"]
            kept = [n for n in part.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*carried, pa.array(names[best], pa.string()), pa.array(score)], names=[*kept, "lang_pred", "score"]
            )


def predict(docs: DataFrame, model: tuple, carried: Column, reject: float = 0.0) -> DataFrame:
    """``carried``, ``lang_pred`` and ``score``, the largest cosine."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    narrow = docs.select(carried.alias("carried"), F.col("text").cast("string").alias("text"))
    kind = narrow.schema["carried"].dataType.simpleString()
    return narrow.mapInArrow(
        lambda it: _predict(it, sent, reject), f"carried {kind}, lang_pred string, score double"
    )

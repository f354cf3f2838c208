"""Every operator against brute force, with nulls, empty and long texts, ties and repeats."""

from __future__ import annotations

import glob
import hashlib
import os
import random
import re
import time

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyport.llm import decontam, graph, hilbert, jaccard, langid, linededup, mixing, pii, quality, tokens, topk
from tallyport.llm.order import with_rows
from tallyport.runtime import settle_table, work_folder

from ..conftest import SMALL
from .conftest import BLANK, PLAIN, lower

ODD = [(None, "a b c"), (1, None), (2, ""), (2, ""), (3, " \n "), (4, "word " * 30_000), (4, "x" * 200_000)]


# --- quality ---------------------------------------------------------------------------


def test_quality_separates_held_out_rows(spark, documents):
    draw = random.Random(1)
    good = [(i, " ".join(draw.choice("abcdefgh") * 3 for _ in range(40))) for i in range(400)]
    bad = [(i, " ".join(draw.choice("abcdefgh") * 3 + " |" for _ in range(40))) for i in range(400, 800)]
    docs = documents(good + bad)
    labels = spark.createDataFrame([(i, int(i < 400)) for i in range(800)] + [(None, 1), (5, None)], "doc_id long, quality int")
    weights = quality.fit(docs, labels)
    held = quality.score(docs.where(quality.remainder(4) == 2), weights, F.col("doc_id")).collect()
    assert len(held) > 100
    assert np.mean([(r["score"] >= 0.5) == (r["carried"] < 400) for r in held]) > 0.97
    kept = quality.keep_good(docs, weights, 0.5)
    assert kept.columns == docs.columns and 350 < kept.count() < 450


def test_quality_of_odd_rows(spark, documents):
    docs = documents(ODD)
    none = spark.createDataFrame([], "doc_id long, quality int")
    scored = quality.score(docs, quality.fit(docs, none), F.col("doc_id")).collect()
    assert [r["score"] for r in scored] == [0.5] * len(ODD)
    assert quality.score(docs.limit(0), np.zeros((1 << quality.BITS) + 1), F.col("doc_id")).count() == 0


def test_driver_gets_one_state_a_round(spark, documents, monkeypatch):
    draw, bits = random.Random(2), 10
    docs = documents([(i, " ".join(draw.choice("abcdefgh") * (1 + i % 2) for _ in range(9))) for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, label int")
    rows = quality.examples(docs, labels, bits=bits)
    held = rows.withColumn("shard", F.expr("pmod(draw, 3)")).withColumnRenamed("values", "values_").toPandas()
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    for _ in range(2):
        models = []
        for _, part in sorted(held.groupby("shard")):
            models.append(quality.Ftrl(z.copy(), n.copy()))
            for _ in range(quality.PASSES):
                for row in part.sort_values("draw").itertuples():
                    at = np.append(np.frombuffer(row.buckets, np.int32), 1 << bits)
                    x = np.append(np.frombuffer(row.values_, np.float32), 1.0).astype(np.float64)
                    models[-1].learn(at, x, row.label, 1.0)
        z, n = np.mean([m.z for m in models], axis=0), np.mean([m.n for m in models], axis=0)

    sent, collect = [], type(rows).collect

    def counted(df):
        found = collect(df)
        sent.append([sum(len(v) for v in r if isinstance(v, (bytes, bytearray))) for r in found])
        return found

    monkeypatch.setattr(type(rows), "collect", counted)
    weights = quality.train(rows, rounds=2, shards=3, bits=bits)
    assert np.array_equal(weights, quality.Ftrl(z, n).weights())
    assert [sum(s) for s in sent if sum(s)] == [16 * ((1 << bits) + 1)] * 2
    assert max(map(max, filter(None, sent))) <= 16 * ((1 << bits) // quality.SLICES + 1)


# --- decontamination -------------------------------------------------------------------


def contaminated(texts, items, size=13):
    table = {}
    for item, text in items:
        w = PLAIN.findall(lower(text))
        for k in range(max(1, len(w) - size + 1) if w else 0):
            table.setdefault(tuple(w[k : k + size]), set()).add(item)
    out = []
    for text in texts:
        w, hit, found = PLAIN.findall(lower(text)), set(), set()
        for length in {len(k) for k in table}:
            for k in range(len(w) - length + 1):
                if names := table.get(tuple(w[k : k + length])):
                    hit |= set(range(k, k + length))
                    found |= names
        out.append((len(w), len(hit), sorted(map(str, found)), bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block", [3, 1000])
def test_phrases_equal_brute_force(spark, documents, monkeypatch, block):
    draw = random.Random(2)
    words = [f"w{i}" for i in range(12)] + ["the"] * 20
    items = [(i, " ".join(draw.choices(words, k=n))) for i, n in enumerate([20, 13, 5, 1, 30, 30])]
    items += [(10, items[0][1]), (11, None), (12, ""), (13, "CafÉ Thé, X")]
    texts = [" ".join(draw.choices(words, k=60)) + (" " + items[i % 6][1].upper() if i % 3 else "") for i in range(40)]
    texts += ["a CafÉ thé x b", None, "", "the " * 5000]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = documents([(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[1])])
    index = decontam.build_index(docs.repartition(3))
    got = decontam.contamination(decontam.find_phrases(index, benchmark, block=block)).collect()
    wanted = contaminated([*texts, texts[0], texts[1]], items)
    ids = [*range(len(texts)), 0, None]
    key = lambda r: (r[0] is None, r)
    have = [(r["doc_id"], r["n_words"], r["n_hit"], sorted(map(str, r["items"])), r["contaminated"]) for r in got]
    assert sorted(have, key=key) == sorted(((i, *w) for i, w in zip(ids, wanted, strict=True)), key=key)


def test_proximity_and_empty_sides(spark, documents):
    item = "alpha beta gamma"
    docs = documents([(1, "alpha x beta gamma"), (2, "alpha x y z beta gamma"), (3, item)])
    index = decontam.build_index(docs)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    hits = {s: {r["doc_id"] for r in decontam.find_phrases(index, benchmark, slack=s).collect() if r["spans"]} for s in (0, 1)}
    assert hits == {0: {3}, 1: {1, 3}}
    assert decontam.find_phrases(index, benchmark.limit(0)).where("size(spans) > 0").count() == 0
    assert decontam.find_phrases(decontam.build_index(docs.limit(0)), benchmark).count() == 0
    assert [r["doc_id"] for r in decontam.clean(docs, benchmark).orderBy("doc_id").collect()] == [1, 2]


def test_index_is_held_one_segment_at_a_time(spark, documents, monkeypatch):
    monkeypatch.setattr(decontam, "HELD", 1_000_000, raising=False)
    cut = decontam.pieces
    monkeypatch.setattr(decontam, "pieces", lambda batches, column, most=30_000: cut(batches, column, most))
    draw = random.Random(4)
    docs = documents([(i, " ".join(f"v{draw.randrange(10_000)}" for _ in range(5000))) for i in range(60)]).coalesce(1)
    index = decontam.build_index(docs)
    path = index.inputFiles()[0].removeprefix("file:")
    stored = pq.ParquetFile(path).metadata
    assert index.count() == 60 and len(index.inputFiles()) == 1
    assert max(stored.row_group(i).total_byte_size for i in range(stored.num_row_groups)) < 2_000_000 < 2 * stored.num_row_groups * 1_000_000
    item = " ".join(docs.where("doc_id = 7").first()["text"].split()[100:113])
    found = decontam.find_phrases(index, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert [r["doc_id"] for r in found.where("size(spans) > 0").collect()] == [7]
    assert found.count() == 60 and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000"


def test_only_terms_of_windows_are_shuffled(spark, documents):
    docs = documents([(i, " ".join(f"v{i}x{j}" for j in range(200))) for i in range(50)])
    index = decontam.build_index(docs)
    cut = decontam.windows(spark.createDataFrame([(1, "v3x1 v3x2")], "item_id long, text string"))
    ranked = decontam.ranked_windows(index, cut)
    assert ranked.count() == 1
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan


# --- sharding --------------------------------------------------------------------------


@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 2), (4, 2)])
def test_the_curve_visits_neighbours(spark, dims, bits):
    axes = [spark.range(1 << bits).select(F.col("id").cast("int").alias(f"c{i}")) for i in range(dims)]
    grid = axes[0]
    for axis in axes[1:]:
        grid = grid.crossJoin(axis)
    names = [f"c{i}" for i in range(dims)]
    points = grid.withColumn("h", hilbert.hilbert_index([F.col(n) for n in names], bits)).orderBy("h").collect()
    assert [r["h"] for r in points] == list(range(1 << bits * dims))
    for a, b in zip(points, points[1:], strict=False):
        assert sum(abs(a[n] - b[n]) for n in names) == 1


def test_shards_are_even_runs(spark, documents):
    draw = random.Random(3)
    rows = [(i, "t" * draw.randrange(50), draw.choice(["en", None, "de"]), draw.choice("abc")) for i in range(200)]
    docs = documents([*rows, *ODD, *[(9, "same", "en", "hot")] * 100])
    placed = hilbert.place(docs, 24).collect()
    counts = {}
    for r in placed:
        counts.setdefault(r["shard"], []).append(r["slot"])
    assert len(placed) == docs.count() and set(counts) == set(range(24))
    assert all(sorted(v) == list(range(len(v))) for v in counts.values())
    assert max(map(len, counts.values())) - min(map(len, counts.values())) <= 1
    assert hilbert.place(docs.limit(0), 24).count() == 0


def test_written_shards_hold_all_rows(spark, documents, tmp_path):
    docs = documents([(i, f"text {i}", "en", f"s{i % 5}") for i in range(50)])
    bounds = hilbert.write_shards(docs, f"{tmp_path}/shards", 4).collect()
    assert sum(r["rows"] for r in bounds) == 50
    back = spark.read.parquet(f"{tmp_path}/shards").select("doc.*")
    assert sorted(back.collect()) == sorted(docs.collect())


# --- token counts ----------------------------------------------------------------------


def test_tokens_equal_the_encoder(spark, documents):
    docs = documents([*ODD, (7, "Licht <|endoftext|> und 漢字"), (8, "one two")])
    codes = tokens.encoder(tokens.VOCABULARY)
    got = sorted(((r["doc_id"], r["n_tokens"]) for r in tokens.document_tokens(docs).collect()), key=str)
    wanted = [(r["doc_id"], len(codes.encode_ordinary(r["text"] or ""))) for r in docs.collect()]
    assert got == sorted(wanted, key=str)
    assert tokens.document_tokens(docs.limit(0)).count() == 0


def test_token_counts_are_never_sent_to_the_driver(spark, documents):
    docs = documents([(i, "one two three " * (i % 7)) for i in range(300)])
    found = tokens.document_tokens(docs)
    assert found.count() == 300
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_documents_across_blocks(spark, tmp_path, block):
    ids = [5, 6, 0, 0, 7, 8, 9, 10, 11, 0, 1, 0, 2, 3]
    np.array(ids, np.uint16).tofile(f"{tmp_path}/a.bin")
    np.array([0, 0], np.uint16).tofile(f"{tmp_path}/b.bin")
    np.zeros(0, np.uint16).tofile(f"{tmp_path}/c.bin")
    paths = spark.createDataFrame([(f"{tmp_path}/{n}.bin",) for n in "abc"], "path string")
    found = tokens.count_tokens(paths, end=0, block=block).orderBy("path", "place").collect()
    assert [(r["path"][-5], r["place"], r["n_tokens"]) for r in found] == [
        ("a", 0, 2), ("a", 1, 0), ("a", 2, 5), ("a", 3, 1), ("a", 4, 2), ("b", 0, 0), ("b", 1, 0),
    ]


# --- language --------------------------------------------------------------------------


def test_languages_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = langid.train(langid.examples(docs.where(quality.remainder(3) != 1), most=20))
    rows = docs.select(F.struct("doc_id", "lang").alias("known"), "text", (quality.remainder(3) == 1).alias("held"))
    found = langid.predict(rows.where("held"), model, F.col("known")).collect()
    right = [r["carried"]["lang"] == r["lang_pred"] for r in found if r["carried"]["lang"]]
    assert len(right) > 30 and np.mean(right) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)


def test_languages_of_odd_rows(documents):
    docs = documents([(1, "ein haus", "de"), (2, "a house", "en"), (3, None), (4, "12 34!"), (5, "漢字"), (6, "")])
    model = langid.train(langid.examples(docs))
    got = {r["carried"]: r["lang_pred"] for r in langid.predict(docs, model, F.col("doc_id")).collect()}
    assert got[3] == got[4] == got[6] == "und" and got[5] in ("de", "en") and (got[1], got[2]) == ("de", "en")
    far = {r["carried"]: r["lang_pred"] for r in langid.predict(docs, model, F.col("doc_id"), reject=0.5).collect()}
    assert far[5] == "und" and far[1] == "de"
    nothing = langid.train(langid.examples(docs.limit(0)))
    assert {r["lang_pred"] for r in langid.predict(docs, nothing, F.col("doc_id")).collect()} == {"und"}


def test_copies_of_a_text_are_one_example(documents):
    texts = {x: [f"{x * 3} {i:03d} " + "".join(chr(97 + int(d)) for d in str(i * i)) for i in range(60)] for x in "pq"}
    rows = [(t, x) for x, ts in texts.items() for t in ts]
    hot = [(texts["p"][i], "p") for i in range(60) for _ in range(i % 3 * 30)]
    docs = documents([(i, *r) for i, r in enumerate(rows + hot)])

    def vectors(frame):
        return sorted((r["lang"], tuple(r["buckets"]), tuple(r["counts"])) for r in frame.collect())

    for most in (5, 40, 1000):
        once = documents([(i, *r) for i, r in enumerate(rows)], "once")
        got = vectors(langid.examples(docs, most=most))
        assert len(got) == 2 * min(most, 60) and got == vectors(langid.examples(once, most=most))


# --- personal data ---------------------------------------------------------------------

_BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in _BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((pii.KINDS.index(kind), *m.span()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    draw = random.Random(4)
    parts = ["a@b.c", "@", ".", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "+1 (555) 555-1234", "x_", "-", " ", "é", "7", "%+"]
    for _ in range(3000):
        text = "".join(draw.choices(parts, k=draw.randrange(8)))
        assert sorted(pii.base_spans(text)) == plain_spans(text), text
    assert pii.base_spans("a" * 100_000 + "1" * 100_000) == []


def test_patterns_find_unseen_numbers(documents):
    known = [(i, f"text tel: +1 (212) 555-{1000 + i} more {'x' * i}") for i in range(20)]
    docs = documents([*known, (50, "ring tel: +44-20-79461 now"), (51, "room 7946 here"), (52, None), (53, "")])
    found = {r["doc_id"]: r for r in pii.find(docs).select("doc_id", pii.as_text("base").alias("base"), pii.as_text("spans").alias("spans")).collect()}
    assert found[50]["base"] == "phone:10:22"
    assert found[51]["spans"] == found[52]["spans"] == found[53]["spans"] == ""
    loose = documents([*[(i, f"tel: +1-212-555-{1000 + i} y") for i in range(20)], (60, "tel: 1-7946 y"), (61, "tel: +1-79 y")], "loose")
    more = {r["doc_id"]: r["spans"] for r in pii.find(loose).select("doc_id", pii.as_text("spans").alias("spans")).collect()}
    assert more[61] == "phone:5:10" and more[60] == ""
    assert pii.redact("mail a@b.cd ok", [(0, 5, 11)]) == "mail <email> ok"
    assert pii.find(docs.limit(0)).count() == 0


def test_numbers_end_at_the_digits_of_their_kind():
    def tokens(text):
        return [(t["start"], t["end"]) for t in pii._candidates(text, text.encode(), sorted(pii.base_spans(text)))]

    assert tokens("+1 212 555 0100 12 30 45 2024 11") == [(0, 21), (22, 32)]
    assert tokens("1234 5678 9012 3456 7890 1") == [(0, 19), (20, 26)]
    assert tokens("10.0.0.1 10.0.0.2 7 8") == [(0, 8), (9, 17), (18, 21)]
    many = " ".join(f"10.{i // 250}.{i % 250}.1" for i in range(8000))
    assert len(tokens(many)) == 8000


def plain_good_patterns(tokens, support, confidence, rounds):
    """The pattern-instance graph in plain dictionaries."""
    n = {}
    for t in tokens:
        for p in t["patterns"]:
            n[p, t["instance"], t["kind"]] = n.get((p, t["instance"], t["kind"]), 0) + 1
    total = {}
    for (p, _, _), c in n.items():
        total[p] = total.get(p, 0) + c
    known, good = {}, {}
    for _ in range(rounds):
        mass, different = {}, {}
        for (p, i, k), c in n.items():
            for kind, score in [(k, 1.0)] if k >= 0 else known.get(i, []):
                mass[p, kind] = mass.get((p, kind), 0) + c * score
                different[p, kind] = different.get((p, kind), 0) + 1
        good = {pk: m / total[pk[0]] for pk, m in mass.items() if different[pk] >= support and m / total[pk[0]] >= confidence}
        missed = {}
        for p, i, k in n:
            for (q, kind), sure in good.items() if k < 0 else ():
                if q == p:
                    missed[i, kind] = missed.get((i, kind), 1.0) * max(1 - sure, 1e-6)
        known = {}
        for (i, kind), m in missed.items():
            if 1 - m >= confidence:
                known.setdefault(i, []).append((kind, 1 - m))
    return sorted(good)


def planted(draw, count):
    """Card numbers between words that tell of them, unseen ones (they fail Luhn) too, and decoys:
    numbers of 16 digits elsewhere."""
    def number(good):
        while True:
            digits = "".join(draw.choices("0123456789", k=16))
            if pii.luhn(digits) == good:
                return digits

    words = ["ala", "bel", "cor", "dun", "eth", "fim", "gor", "hul"]
    rows = []
    for i in range(count):
        kind = draw.choice(["seed"] * 20 + ["unseen"] + ["decoy"] * 5)
        said = number(kind == "seed")
        before, after = " ".join(draw.choices(words, k=4)), " ".join(draw.choices(words, k=4))
        left, right = draw.choice([("card:", ""), ("", "expires"), ("paid with", "expires")]) if kind != "decoy" else ("", "")
        rows.append((i, f"{before} {left} {said} {right} {after}", kind, said))
    return rows


def test_unseen_numbers_are_found_and_decoys_left_alone(documents):
    rows = planted(random.Random(6), 1200)
    docs = documents([(d, t) for d, t, _, _ in rows])
    scanned = pii.scan(docs)
    tokens = [t for r in scanned.collect() for t in r["tokens"]]
    good = pii.good_patterns(scanned).collect()
    assert sorted((r["pattern"], r["kind"]) for r in good) == plain_good_patterns(tokens, pii.SUPPORT, pii.CONFIDENCE, pii.ROUNDS)
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in pii.find(docs).collect()}
    found = {k: [spans[d] == [(t.index(n), t.index(n) + 16)] for d, t, kind, n in rows if kind == k] for k in ("seed", "unseen")}
    wrong = [spans[d] for d, _, kind, _ in rows if kind == "decoy" and spans[d]]
    assert all(found["seed"]) and not wrong
    assert len(found["unseen"]) > 30 and np.mean(found["unseen"]) >= 0.95


def test_patterns_find_whole_numbers_with_blanks(documents):
    def card(i):
        body = f"4000 00{i:02d} 1234 {i * 7 % 1000:03d}"
        return next(body + str(c) for c in range(10) if pii.luhn(body.replace(" ", "") + str(c)))

    known = [f"pay card: {card(i)} tel: +1 (212) 555-{1000 + i} end" for i in range(60)]
    unseen = [
        "pay card: 1234 5678 9012 3456, end", "pay card: 1234567890123456 end", "pay card: 1234 5678-9012  3456. end",
        "tel: +1 (212) 55 end", "tel: +44 20 - 79 +1", "pay card: 1234 5678\n9012 times", "12 34 56 7x 8", "room 12 34",
    ]
    docs = documents(list(enumerate([*known, *unseen, *(f"pay card:{card(i)} end" for i in range(60)), "pay card:1234 5678 9012 3456 end"])))
    rows = {r["doc_id"]: r["spans"] for r in pii.find(docs).select("doc_id", pii.as_text("spans").alias("spans")).collect()}
    assert [rows[60 + i] for i in range(len(unseen))] == [
        "card:10:29", "card:10:26", "card:10:30", "phone:5:16", "phone:5:16", "card:10:19", "", "",
    ]
    assert rows[len(docs.collect()) - 1] == "card:4:28"


# --- top k -----------------------------------------------------------------------------


@pytest.mark.parametrize("shape", ["random", "ties"])
def test_top_k_equals_brute_force(spark, tmp_path, monkeypatch, shape):
    monkeypatch.setattr(topk, "SEGMENT", 64)
    draw = np.random.default_rng(5)
    table = draw.normal(size=(500, 12)) if shape == "random" else draw.integers(-2, 3, size=(500, 3)) / 2
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(table)]
    rows += [(1000, None), (1001, [1.0, None, 2.0]), (1002, [float("nan")] * 12), (None, [1.0]), (7, [0.5]), (1003, [])]
    path = f"{tmp_path}/vectors"
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(path)
    vectors = spark.read.parquet(path)
    got = topk.search(topk.build_index(vectors), vectors, F.col("vec_id") % 50 == 0, k=5, block=4).collect()
    width = table.shape[1]
    usable = [(i, np.floor(1024 * np.pad(np.float32(v).astype(float), (0, width - len(v))))) for i, v in rows[:500] + [rows[-2], rows[-1]]]
    wanted = []
    for at, (q, v) in enumerate(usable):
        if q % 50 == 0:
            scores = sorted((-int(v @ w), i) for j, (i, w) in enumerate(usable) if j != at)[:5]
            wanted += [(q, r, i, -s) for r, (s, i) in enumerate(scores, 1)]
    assert sorted(tuple(r) for r in got) == sorted(wanted)
    assert topk.search(topk.build_index(vectors.limit(0)), vectors.limit(0), F.lit(True)).count() == 0


# --- lines -----------------------------------------------------------------------------


def alike(a, b, least=5):
    if a == b:
        return True
    if min(len(a), len(b)) < least or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


@pytest.mark.parametrize("piece", [200, 4_000_000])
def test_lines_equal_brute_force(spark, documents, monkeypatch, piece):
    whole = linededup.pieces
    monkeypatch.setattr(linededup, "pieces", lambda it, column, most: whole(it, column, piece))
    draw = random.Random(6)
    lines = []
    for _ in range(60):
        line = [draw.choice("abc") for _ in range(draw.choice([1, 3, 4, 5, 6, 9, 12]))]
        lines.append(line)
        if draw.random() < 0.5:
            other = list(line)
            i = draw.randrange(len(other))
            if draw.random() < 0.5:
                other[i] = "z"
            else:
                del other[i]
            lines.append(other)
    draw.shuffle(lines)
    texts = ["\n".join(" ".join(x) for x in lines[i : i + 4]) for i in range(0, len(lines), 4)]
    rows = [(i, t) for i, t in enumerate([*texts, None, "", "\n\n", texts[0]])]
    docs = documents(rows)
    ids = with_rows(docs).select("row", "doc.doc_id")
    found = ids.join(linededup.repeated_lines(docs), "row")
    got = {r["doc_id"]: (r["n_lines"], list(r["dropped"])) for r in found.collect()}
    order = [r["doc_id"] for r in ids.orderBy("row").collect()]
    texts_by_id = dict(rows)
    seen = []
    for i in order:
        drop, parts = [], [] if texts_by_id[i] is None else texts_by_id[i].split("\n")
        for k, line in enumerate(parts):
            w = BLANK.findall(line)
            if w:
                drop += [k] if any(alike(w, s) for s in seen) else []
                seen.append(w)
        assert got[i] == (len(parts), drop), i
    assert linededup.without_lines("a\nb\nc", [1]) == "a\nc"
    assert linededup.repeated_lines(docs.limit(0)).count() == 0


def test_very_long_lines_take_one_edit(documents):
    long = [f"w{i}" for i in range(70_000)]
    edited = [long[:69_990] + ["z"] + long[69_991:], long[:69_000] + long[69_001:], long[:3] + ["z"] + long[3:]]
    twice = ["z", *long[1:65_600], "z", *long[65_601:]]
    rows = [(i, " ".join(words)) for i, words in enumerate([long, *edited, twice, long[:65_533], long[1:65_533]])]
    docs = documents(rows).repartition(1).sortWithinPartitions("doc_id")
    found = sorted((r["row"], list(r["dropped"])) for r in linededup.repeated_lines(docs).collect())
    assert [dropped for _, dropped in found] == [[], [0], [0], [0], [], [], [0]]


# --- mixing ----------------------------------------------------------------------------


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {n: weights[i % 3] for i, n in enumerate(names)}
    target, full = {}, set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[n] for n in full)
        free = [n for n in names if n not in full]
        target = {n: most * sizes[n] for n in full}
        target |= {n: left * weight[n] / sum(weight[m] for m in free) for n in free}
        over = {n for n in free if target[n] > most * sizes[n]}
        if not over:
            return target
        full |= over


def test_mix_meets_its_targets(documents):
    draw = random.Random(7)
    counts = {"a": 20, "b": 300, "c": 100, None: 80, "e": 500, "f": 10}
    rows = [(i, "w " * draw.randrange(60), None, s) for i, (s, n) in enumerate((s, n) for s, k in counts.items() for n in range(k))]
    docs = documents([*rows, (None, None, None, "g"), (1, "", None, "g")])
    got = mixing.mix(docs).collect()
    sizes = {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    wanted, taken = plain_targets(sizes), {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and 0 <= r["copies"] <= 3
        assert r["target"] == pytest.approx(wanted[r["source"]])
        taken[r["source"]] = taken.get(r["source"], 0) + r["copies"] * r["size"]
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= 60
    again = {(r["row"], r["copies"]) for r in mixing.mix(docs.repartition(1)).collect()}
    assert len(got) == docs.count() and len(again) == len(got)
    assert sorted(r["copies"] for r in got) == sorted(c for _, c in again)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in got)
    assert mixing.mix(docs.limit(0)).count() == 0


# --- near copies -----------------------------------------------------------------------


def plain_components(rows, words, percent):
    sets = []
    for _, text in rows:
        w = BLANK.findall(lower(text))
        grams = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}
        sets.append(grams if len(w) >= words else {tuple(w)} if w else set())
    roots = list(range(len(rows)))

    def find(i):
        while roots[i] != i:
            i = roots[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                roots[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("words, percent, cell", [(3, 90, 1 << 17), (3, 90, 40), (5, 80, 200), (1, 60, 20)])
def test_components_equal_brute_force(documents, monkeypatch, words, percent, cell):
    monkeypatch.setattr(jaccard, "CELL", cell)
    draw = random.Random(8)
    rows = []
    for _ in range(60):
        base = [draw.choice("abcdefghijklmnop") for _ in range(draw.choice([1, 2, 4, 8, 11, 20, 40, 150]))]
        for _ in range(draw.choice([1, 1, 2, 5])):
            copy = list(base)
            for _ in range(draw.randrange(3)):
                copy[draw.randrange(len(copy))] = draw.choice("XYZ")
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows), ""), (len(rows) + 1, None), (0, "q r s"), (0, "q r s")]
    got = jaccard.classes(documents(rows), words, percent).collect()
    assert sorted((r["doc_id"], r["n"], r["component_id"]) for r in got) == plain_components(rows, words, percent)


def test_one_of_each_group_stays(documents):
    text = " ".join(f"w{i}" for i in range(100))
    docs = documents([(5, text), (3, text), (3, text + " more"), (1, None), (1, ""), (9, "other words here entirely new")])
    kept = jaccard.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect())[:2] == [1, 1] and kept.count() == 4
    assert jaccard.classes(docs.limit(0)).count() == 0


def _stored(spark):
    return sum(os.path.getsize(f) for f in glob.glob(f"{work_folder(spark)}/**/*.parquet", recursive=True))


def test_elements_of_sets_are_not_stored(spark, documents):
    draw = random.Random(3)
    docs = documents([(i, " ".join(draw.choice("abcdefghijklmnop") for _ in range(2000))) for i in range(150)])
    before = _stored(spark)
    elements = sum(r["n"] for r in jaccard.classes(docs, 5, 80).collect())
    assert elements > 250_000 and _stored(spark) - before < 4 * elements


def test_cells_meet_in_rounds(spark, documents, monkeypatch):
    monkeypatch.setattr(jaccard, "CELL", 300)
    seen, settle = [], jaccard.settle_table

    def counted(df, label, **options):
        seen.append(label)
        return settle(df, label, **options)

    monkeypatch.setattr(jaccard, "settle_table", counted)
    text = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join([*text[:i], "x", *text[i + 1 :]])) for i in range(30)]
    got = jaccard.classes(documents(rows), 1, 80).collect()
    # About 30 sets in ten cells each: ten times the elements of all sets.
    assert {r["component_id"] for r in got} == {0} and seen.count("links") >= 8


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return set(re.findall(r"shuffle_\d+_\d+_\d+\.\w+", files.mkString(" ")))


def test_written_tables_leave_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    held = settle_table(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count(), "counts")
    for _ in range(25):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left and held.count() == 10
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1100)] + [(7, 7)]
    found = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    roots = {}
    for r in found:
        roots.setdefault(r["root"], set()).add(r["node"])
    assert sorted(map(len, roots.values())) == [100, 201]
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_digest_of_no_items_is_of_the_empty_text(spark, documents):
    row = documents([(1, "a")]).select(F.sha2(F.array_join(F.array().cast("array<string>"), ","), 256).alias("h")).first()
    assert row["h"] == hashlib.sha256(b"").hexdigest()
    assert pa.array([None], pa.string()).null_count == 1

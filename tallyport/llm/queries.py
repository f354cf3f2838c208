"""One registered query per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.llm import article, codes, decontam, hilbert, jaccard, langid, linededup, mixing, periodic, pii, quality, tokens, topk
from tallyport.llm.order import with_rows


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    weights = quality.fit(docs, read(spark, folder, "labels"))
    scored = quality.score(docs, weights, F.col("doc_id")).withColumnRenamed("carried", "doc_id")
    held_out = (quality.remainder(4) == 2).alias("held_out")
    predicted = (F.col("score") >= 0.7).cast("int").alias("predicted")
    return scored.select("doc_id", held_out, "score", predicted)


def op2_benchmark_index(spark: SparkSession, folder: str) -> DataFrame:
    index = decontam.build_index(read(spark, folder, "documents"))
    found = decontam.contamination(decontam.find_phrases(index, read(spark, folder, "benchmark")))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(names, 256).alias("items_sha256"), "contaminated"
    )


def op3_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = hilbert.place(read(spark, folder, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_separator_scan(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.document_tokens(read(spark, folder, "documents"))


def op5_language_centroids(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = langid.train(langid.examples(docs.where(quality.remainder(3) != 1)))
    found = langid.predict(docs, model, F.col("doc_id")).withColumnRenamed("carried", "doc_id")
    return found.select("doc_id", (quality.remainder(3) == 1).alias("held_out"), "lang_pred", "score")


def _of_kind(kind: int):
    return lambda span: span["kind"] == kind


def op6_contextual_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(read(spark, folder, "documents"))
    counts = [
        F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{name}")
        for k, name in enumerate(pii.KINDS)
    ]
    digest = F.sha2(pii.as_text("base"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, pii.as_text("spans").alias("spans"))


def op7_impact_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings")
    return topk.search(topk.build_index(vectors), vectors, F.col("vec_id") % 100 == 0, k=10)


def op8_line_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    ids = with_rows(docs).select("row", "doc.doc_id")
    found = ids.join(linededup.repeated_lines(docs), "row")
    kept = (F.col("n_lines") - F.size("dropped")).alias("n_kept")
    lines = F.array_join(F.transform("dropped", lambda n: n.cast("string")), ",").alias("dropped_lines")
    return found.select("doc_id", "n_lines", kept, lines)


def op9_systematic_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(read(spark, folder, "documents"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


def op10_shingle_join(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard.classes(read(spark, folder, "documents"), words=3, percent=90)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def op11_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages")
    found = article.main_text(pages, article.train(pages), F.struct("page_id", "url"))
    return found.select("carried.page_id", "carried.url", "text", F.length("text").cast("long").alias("n_chars"))


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings")
    books = codes.train(vectors)
    found = codes.with_label_error(codes.encode(vectors, books, "vec_id", "label"))
    digits = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    return found.select(
        "vec_id", F.array_join(digits, "").alias("code"), "error", "label_error",
        F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256"),
    )


def planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, in which every tenth document repeats a stretch of its words."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))
    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text"), (h % 10 == 0).alias("planted"), F.expr(
        "floor(crc32(cast(doc_id as string)) / 10)").alias("g"), F.when(h % 10 == 0, words).alias("words"))
    sized = chosen.withColumn("n", F.size("words")).withColumn("a", F.expr("if(n > 0, g % n, 0)"))
    step = sized.withColumn("p", F.expr("1 + floor((n - a) / (3 + g % 8))"))
    made = F.expr("array_join(transform(words, (w, i) -> if(i < a, w, words[int(a + (i - a) % p)])), ' ')")
    return step.select("doc_id", F.when(F.col("planted") & (F.col("n") > 0), made).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = planted_runs(read(spark, folder, "documents"))
    found = periodic.find_runs(docs, F.col("doc_id")).withColumnRenamed("carried", "doc_id")
    best = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start as start, -r.period as period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_benchmark_index": op2_benchmark_index,
    "op3_hilbert_shards": op3_hilbert_shards,
    "op4_separator_scan": op4_separator_scan,
    "op5_language_centroids": op5_language_centroids,
    "op6_contextual_pii": op6_contextual_pii,
    "op7_impact_search": op7_impact_search,
    "op8_line_neighbours": op8_line_neighbours,
    "op9_systematic_mix": op9_systematic_mix,
    "op10_shingle_join": op10_shingle_join,
    "op11_main_text": op11_main_text,
    "op12_vector_codes": op12_vector_codes,
    "op13_periodic_runs": op13_periodic_runs,
}

"""Stored digest trees: settings, descent and restarts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyport.operators import baseline, compare

SIZE = 10


@pytest.fixture
def table(spark):
    def make(keys, changed=()):
        value = F.when(F.col("k").isin(list(changed)), "new").otherwise("old") if changed else F.lit("old")
        df = spark.createDataFrame([(k,) for k in keys], "k long")
        return df.withColumn("v", value).withColumn("x", F.col("k") / 8)

    return make


def tree(df, described=None, **settings):
    described = described or baseline.describe(df, "t", "k", SIZE, **({"scales": {"x": 2}, "fanout": 3} | settings))
    return baseline.digest_tree(df, described)


def drifts(old, new, **how):
    found = baseline.drift(old, new, **how)
    return {r["chunk_id"]: (r["drift"], r["baseline_rows"], r["current_rows"]) for r in found.collect()}


def test_equal_tables_have_one_root(table, spark):
    old = tree(table(range(200)))
    assert old.height == 3 and old.level(3).count() == 1
    same = tree(table(reversed(range(200))).repartition(3), old.description)
    assert same.root() == old.root() and drifts(old, same) == {}
    assert set(v[0] for v in drifts(old, same, with_same=True).values()) == {"SAME"}


def test_descent_finds_what_a_full_comparison_finds(table):
    old = tree(table(range(150)))
    for keys, changed in [
        ([*range(1, 70), *range(100, 150)], [7]), ([*range(-25, 150), None, None, 5, *range(900, 950)], [0]), ([], []),
    ]:
        new = table(keys, changed)
        got = drifts(old, tree(new, old.description), with_same=True)
        low = F.lit(0).cast("bigint")
        full = compare.fingerprint_drift(
            *(compare.chunk_digests(df, "t", "k", SIZE, ["k", "v", "x"], {"x": 2}, low) for df in (table(range(150)), new))
        )
        assert {c: d[0] for c, d in got.items()} == {r["chunk_id"]: r["drift"] for r in full.collect()}
        few = drifts(old, tree(new, old.description))
        assert few == {c: d for c, d in got.items() if d[0] != "SAME"}


def test_a_level_looks_at_the_children_of_what_differs(table, monkeypatch):
    old = tree(table(range(300)))
    new = tree(table(range(300), [77]), old.description)
    seen, settle = [], baseline.settle_table

    def counted(df, label):
        held = settle(df, label)
        seen.append(held.count())
        return held

    monkeypatch.setattr(baseline, "settle_table", counted)
    assert list(drifts(old, new)) == ["t-000008"] and seen == [1] * (old.height + 1)


@pytest.mark.parametrize(
    "settings, named",
    [
        ({"fanout": 4}, "fanout"),
        ({"scales": {"x": 1}}, "scales"),
        ({"columns": ["k", "v"]}, "columns"),
        ({"method": "xxhash64"}, "method"),
    ],
)
def test_other_settings_are_refused(spark, table, tmp_path, settings, named):
    df, path = table(range(50)), f"{tmp_path}/b"
    baseline.save(tree(df), path)
    wanted = baseline.describe(df, "t", "k", SIZE, **({"scales": {"x": 2}, "fanout": 3} | settings))
    with pytest.raises(baseline.BaselineMismatch, match=named):
        baseline.load(spark, path, wanted)
    assert baseline.load(spark, path, baseline.describe(df, "t", "k", SIZE, scales={"x": 2}, fanout=3)).root()


def test_other_key_size_table_and_types_are_refused(spark, table, tmp_path):
    df, path = table(range(50)), f"{tmp_path}/b"
    baseline.save(tree(df), path)
    for name, key, size, named in (("u", "k", SIZE, "table"), ("t", "x", SIZE, "key"), ("t", "k", 20, "size")):
        with pytest.raises(baseline.BaselineMismatch, match=named):
            baseline.load(spark, path, baseline.describe(df, name, key, size, scales={"x": 2}, fanout=3))
    with pytest.raises(baseline.BaselineMismatch, match="columns"):
        baseline.digest_tree(df.withColumn("v", F.lit(1)), baseline.load(spark, path).description)
    with pytest.raises(baseline.BaselineMismatch, match="columns"):
        baseline.digest_tree(df.drop("v"), baseline.load(spark, path).description)
    with pytest.raises(baseline.BaselineMismatch, match="different keys"):
        baseline.drift(baseline.load(spark, path), tree(table(range(3, 50))))


def test_a_changed_description_is_refused(spark, table, tmp_path):
    path = f"{tmp_path}/b"
    baseline.save(tree(table(range(50))), path)
    stored = spark.read.parquet(f"{path}/description")
    forged = stored.withColumn("settings", F.replace("settings", F.lit('"size": 10'), F.lit('"size": 11')))
    rows = [tuple(r) for r in forged.collect()]
    spark.createDataFrame(rows, stored.schema).write.mode("overwrite").parquet(f"{path}/description")
    with pytest.raises(baseline.BaselineMismatch, match="was changed"):
        baseline.load(spark, path)


def test_another_version_is_refused(spark, table, tmp_path, monkeypatch):
    path = f"{tmp_path}/b"
    baseline.save(tree(table(range(50))), path)
    monkeypatch.setattr(baseline, "FINGERPRINT_VERSION", "0")
    with pytest.raises(baseline.BaselineMismatch, match="version"):
        baseline.load(spark, path)


def test_a_run_that_stops_leaves_the_former_baseline(spark, table, tmp_path, monkeypatch):
    path = f"{tmp_path}/b"
    first = tree(table(range(50)))
    baseline.save(first, path)

    def stop(*_):
        raise RuntimeError("stopped")

    second = tree(table(range(60)))
    with monkeypatch.context() as patch:
        patch.setattr(baseline.Description, "sha256", stop)
        with pytest.raises(RuntimeError):
            baseline.save(second, path)
    assert baseline.load(spark, path).root() == first.root()
    baseline.save(second, path)
    assert baseline.load(spark, path).root() == second.root() != first.root()


def test_missing_baselines(spark, table, tmp_path):
    df, path = table(range(30)), f"{tmp_path}/b"
    how = {"scales": {"x": 2}, "fanout": 3}
    with pytest.raises(ValueError, match="no baseline"):
        baseline.drift_against_baseline(df, path, "t", "k", SIZE, **how)
    assert baseline.drift_against_baseline(df, path, "t", "k", SIZE, **how, fail_if_missing=False).count() == 0
    late = baseline.drift_against_baseline(table(range(1, 35)), path, "t", "k", SIZE, **how)
    assert sorted(tuple(r)[1:] for r in late.collect()) == [("t-000001", 10, 9, "CHANGED"), ("t-000004", None, 5, "NEW")]


def test_an_empty_baseline(table):
    old = tree(table([]))
    assert old.root() is None and old.description.low is None
    assert drifts(old, tree(table([]), old.description)) == {}
    assert drifts(old, tree(table([4, None]), old.description)) == {"t-000000": ("NEW", None, 2)}

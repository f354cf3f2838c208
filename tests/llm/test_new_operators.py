"""Main text of pages, vector codes and periodic runs against brute force."""

from __future__ import annotations

import hashlib
import html
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyport.llm import article, codes, periodic
from tallyport.llm.queries import QUERIES, planted_runs

from ..conftest import SMALL
from .conftest import BLANK

# --- main text -------------------------------------------------------------------------

UNTAUGHT = article.Weights({}, {})


def page(body):
    return f"<!DOCTYPE html><html><head><title>t t t</title></head><body>{body}</body></html>"


PROSE = "<p>" + "</p><p>".join("many plain words of prose stand here in a row " * 3 for _ in range(4)) + "</p>"
SAID = "\n".join([" ".join(["many plain words of prose stand here in a row"] * 3)] * 4)


@pytest.mark.parametrize(
    "body",
    [
        f"<nav><ul><li><a href=/>home</a></li></ul></nav><div id=main>{PROSE}</div><footer>foot words</footer>",
        f"<header><h1>Site</h1></header><article>{PROSE}</article><aside><p>{'side ' * 90}</p></aside>",
        f"<div class='cookie-notice'>{'we use cookies ' * 60}</div><main>{PROSE}</main>",
        f"<article>{PROSE}<div class=\"ad\">{'buy ' * 99}</div></article>",
        f"<article>{PROSE}</article><section id='comments'><article class=comment><p>{'I say ' * 99}</p></article></section>",
        f"<div class='navigation'><div>{'<a href=x>go on</a> ' * 50}</div></div>{PROSE}<form>{'<label>name it</label>' * 9}</form>",
        f"<script>var p = '<p>{'word ' * 99}</p>'</script><style>p {{}}</style><!-- {PROSE} -->{PROSE}",
        f"<ul>{'<li><a href=x>one</a></li>' * 40}</ul>{PROSE}<ul>{'<li><a href=x>two</a></li>' * 40}</ul>",
        f"<div role=banner>{'hello ' * 99}</div><div hidden>{'gone ' * 99}</div><div>{PROSE}</div>",
        f"<nav><a href=x>menu</a><main>{PROSE}",
        f"<body class=has-sidebar><div class='page no-comments'>{PROSE}</div>",
    ],
)
def test_only_the_article_stays(body):
    assert article.extract(page(body), UNTAUGHT) == SAID


@pytest.mark.parametrize(
    "text, wanted",
    [
        (None, ""),
        ("", ""),
        ("no markup &lt;at all&gt; &amp; so on", "no markup <at all> & so on"),
        ("<p>" + "a\n \t b&nbsp;c&#10;d " * 9 + "</p><p> </p><p>" + "e<br>f " * 9 + "</p>", "a b c d " * 8 + "a b c d\n" + "e f " * 8 + "e f"),
        ("<p>one <b>bo</b>ld &copy &quot;x&quot; &am 1 < 2", 'one bold © "x" &am 1 < 2'),
        ("<p>cut <a href='x>y", "cut"),
        ("<p>x</p><script>never closed <p>y</p>", "x"),
        ("<p>x<!-- never closed <p>y</p>", "x"),
        ("<p title=\"a > b\" x='</p>' y=it's>word</p>", "word"),
        ("<article></article>", ""),
        ("<p>" + "w" * 300_000 + "</p>", "w" * 300_000),
    ],
)
def test_text_of_odd_pages(text, wanted):
    assert article.extract(text, UNTAUGHT) == wanted


def test_deep_and_broken_pages_take_linear_time():
    for text in ("<div>" * 50_000 + "word", "<" * 200_000, "<a " * 100_000, "<p x='" * 50_000, "<!--" * 50_000, "</div>" * 50_000 + "<li>x" * 20_000, "<script>" * 30_000):
        article.extract(text, UNTAUGHT)


def test_the_region_is_the_best_of_all():
    draw = random.Random(3)
    for _ in range(300):
        scores = [draw.randrange(-4, 5) for _ in range(draw.randrange(0, 12))]
        begin, end = article.best_region(np.array(scores, np.int64))
        sums = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
        assert sum(scores[begin:end]) == max([0, *sums])


def marked_article(text):
    """The article of a page of the test tables, which all mark it."""
    found = re.search(r"<article>(.*?)</article>", text or "", re.S)
    blocks = re.split(r"</?(?:p|h1)>", found[1]) if found else []
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_main_text_query(spark):
    rows = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    got = QUERIES["op11_main_text"](spark, SMALL).collect()
    wanted = [(r["page_id"], r["url"], marked_article(r["html"]), len(marked_article(r["html"]))) for r in rows]
    assert sorted(tuple(r) for r in got) == sorted(wanted)


def test_weights_find_articles_that_are_not_marked(spark, tmp_path):
    """Taught by marked pages, the scan reads the same pages with all names taken away."""
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    weights = article.train(pages)
    assert weights.price in article.PRICES and weights.plain["p"] > 900_000 and weights.plain["<li"] < 100_000
    right = total = 0
    for row in pages.collect():
        bare = re.sub(r"<(/?)(?:article|nav|footer)[^>]*>", r"<\1div>", row["html"] or "").replace(' class="ad"', "")
        got, wanted = article.extract(bare, weights).split(), marked_article(row["html"]).split()
        total += len(wanted)
        right += len(wanted) - abs(len(got) - len(wanted)) if " ".join(wanted) in " ".join(got) or " ".join(got) in " ".join(wanted) else 0
    assert right > 0.97 * total


def test_pages_with_clashing_columns_and_no_pages(spark):
    rows = [(None, None, 1, "k"), (1, "<p>a b</p>", 2, "k"), (1, "<p>a b</p>", 2, "k")]
    pages = spark.createDataFrame(rows, "page_id long, html string, carried int, kind string")
    found = article.main_text(pages, article.train(pages), F.col("page_id")).collect()
    assert sorted(((r["carried"] or 0), r["text"]) for r in found) == [(0, ""), (1, "a b"), (1, "a b")]
    none = pages.limit(0)
    assert article.main_text(none, article.train(none), F.col("page_id")).count() == 0
    assert article.train(pages, examples=1).price == article.PRICES[0]


# --- vector codes ----------------------------------------------------------------------


def plain_codes(rows, parts, entries, rounds, scale=1024):
    """Whole numbers of Python, one comparison after the other."""
    kept = []
    for vec, values, label in rows:
        if values is not None and all(v is not None and np.isfinite(v) for v in values):
            kept.append((vec, [int(np.floor(float(v) * scale)) for v in values], label))
    width = max((len(v) for _, v, _ in kept), default=0)
    width = max(1, -(-width // parts)) * parts
    kept = [(vec, v + [0] * (width - len(v)), label) for vec, v, label in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = width // parts
    cut = [[v[p * size : (p + 1) * size] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign():
        far = [[[sum((a - b) ** 2 for a, b in zip(c[p], e, strict=True)) for e in books[p]] for p in range(parts)] for c in cut]
        return [[d.index(min(d)) for d in f] for f in far], [sum(map(min, f)) for f in far]

    for _ in range(rounds):
        near, _ = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [c[p] for c, n in zip(cut, near, strict=True) if n[p] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    near, error = assign()
    flat = ",".join(str(x) for b in books for e in b for x in e)
    return sorted(
        ((vec if vec is not None else -1, tuple(n), e, label) for (vec, _, label), n, e in zip(kept, near, error, strict=True)), key=repr
    ), hashlib.sha256(flat.encode()).hexdigest()


@pytest.mark.parametrize("size", [1.0, 1e-3, 3e4])
def test_codes_equal_brute_force(spark, size):
    draw = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in draw.normal(size=8) * size], int(i % 3)) for i in draw.permutation(60)]
    rows += [(100, None, 1), (101, [1.0, None] * 4, 1), (102, [float("inf")] * 8, 1), (103, [float("nan")], None)]
    rows += [(None, [0.5 * size] * 8, None), (7, [0.25 * size] * 8, 1), (7, [0.25 * size] * 8, 1), (104, [-size], 2), (105, [], 2)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    books = codes.train(vectors, parts=4, entries=6, rounds=3)
    found = codes.with_label_error(codes.encode(vectors, books, "vec_id", "label")).collect()
    wanted, digest = plain_codes(rows, 4, 6, 3)
    got = [(r["vec_id"] if r["vec_id"] is not None else -1, tuple(r["codes"]), r["error"], r["label"]) for r in found]
    assert sorted(got, key=repr) == wanted and books.sha256() == digest
    total = {}
    for *_, error, label in wanted:
        total[label] = total.get(label, 0) + error
    assert all(r["label_error"] == total[r["label"]] for r in found)


@pytest.mark.parametrize("top", [10, 1 << 20, 1 << 27])
@pytest.mark.parametrize("width", [1, 3, 16, 200])
def test_products_of_limbs_are_exact(top, width):
    draw = random.Random(width)
    width_bits = codes.limb_bits(width)
    assert width << 2 * width_bits <= 1 << 53 < width << 2 * (width_bits + 1) or width_bits == 26
    left = [[draw.randrange(-top, top + 1) for _ in range(width)] for _ in range(9)] + [[-top] * width, [top] * width]
    right = [[draw.randrange(-top, top + 1) for _ in range(width)] for _ in range(7)] + [[-top] * width]
    got = codes.dot_products(np.array(left), np.array(right))
    assert got.tolist() == [[sum(a * b for a, b in zip(x, y, strict=True)) for y in right] for x in left]
    for digits in codes.limbs(np.array(left), width_bits):
        assert np.abs(digits).max() < 1 << width_bits


def test_codes_that_no_long_holds_raise(spark):
    vectors = spark.createDataFrame([(1, [3e6, 1.0]), (2, [-3e6, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="cannot be a long"):
        codes.encode(vectors, codes.train(vectors, parts=1), "vec_id").collect()
    with pytest.raises(OverflowError):
        codes.nearest(np.array([[1 << 61]]), np.array([[0]]))


def test_codes_of_no_vectors_and_clashing_columns(spark):
    kind = "vec_id long, embedding array<float>, label int, codes string, error string, part int"
    none = spark.createDataFrame([(1, None, 1, "a", "b", 1)], kind)
    assert codes.train(none) is None and codes.encode(none, None, "vec_id", "label").count() == 0
    one = spark.createDataFrame([(1, [0.5] * 4, 1, "a", "b", 1)], kind)
    assert [tuple(r) for r in codes.encode(one, codes.train(one), "vec_id").collect()] == [(1, [0, 0, 0, 0], 0)]


# --- periodic runs ---------------------------------------------------------------------


def plain_runs(words, least=6, periods=4):
    found = {}
    for q in range(1, len(words) // periods + 1):
        i = 0
        while i < len(words) - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < len(words) - q and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, periods * q):
                found.setdefault((start, i - start + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_texts(draw, count):
    for _ in range(count):
        letters = "abcé"[: draw.choice([1, 2, 3, 4])]
        words = [draw.choice(letters) for _ in range(draw.randrange(0, 50))]
        if words and draw.random() < 0.6:
            p, a = draw.randrange(1, 9), draw.randrange(len(words))
            words = words[:a] + [words[min(a + i % p, len(words) - 1)] for i in range(len(words) - a)] + ["z"] * draw.choice([0, 1, 7])
        yield draw.choice([" ", "  \t", "\n"]).join(words)


@pytest.mark.parametrize("least, periods", [(6, 4), (2, 2), (1, 3)])
@pytest.mark.parametrize("batch", [1, 300, 1_000_000])
def test_runs_equal_brute_force(documents, monkeypatch, least, periods, batch):
    monkeypatch.setattr(periodic, "BATCH", batch)
    monkeypatch.setattr(periodic, "TESTS", 40)
    rows = list(enumerate(some_texts(random.Random(batch + least), 150)))
    rows += [(None, "a a a a a a a"), (5, None), (6, ""), (6, ""), (7, "\x0b \x0c"), (8, " é" * 9), (9, "w" * 100_000)]
    got = periodic.find_runs(documents(rows), F.col("doc_id"), periodic.Rule(least, periods)).collect()
    wanted = []
    for doc, text in rows:
        words = BLANK.findall(text or "")
        runs = plain_runs(words, least, periods)
        wanted.append((doc, len(words), runs, plain_collapse(words, runs)))
    assert sorted(((r["carried"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got), key=repr) == sorted(wanted, key=repr)


def test_runs_of_very_long_texts(documents):
    one, two = "la " * 120_000, " ".join(str(i % 4_001) for i in range(100_000))
    found = periodic.find_runs(documents([(1, one), (2, two)]), F.col("doc_id")).collect()
    runs = {r["carried"]: [tuple(x) for x in r["runs"]] for r in found}
    assert runs == {1: [(0, 120_000, 1)], 2: [(0, 100_000, 4_001)]}
    assert periodic.find_runs(documents([(1, one)]).limit(0), F.col("doc_id")).count() == 0


def test_runs_query(spark, tmp_path):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").limit(60).collect()
    rows = [tuple(r) for r in rows] + [(d, t) for d in range(1000, 1030) for t in ("a b c d e f g h i j k l m n", "", None)] + [(None, "x x x x x x x")]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    got = [tuple(r) for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()]
    wanted = []
    for doc, text in rows:
        words = BLANK.findall(text or "")
        n, h = len(words), zlib.crc32(str(doc).encode()) if doc is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (lines, plain_collapse(words, runs))]
        wanted.append((doc, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *digests))
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    assert planted_runs(spark.read.parquet(path)).columns == ["doc_id", "text"]

"""Pages, urls and vectors on small tables."""

from __future__ import annotations

import itertools
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from comparison import connect, differences
from conftest import SMALL
from tables import odd_docs  # noqa: F401

import corpus_pipeline
from tidemart.llm import exact_search, hosts, html, permutations
from tidemart.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("key", sorted(SQL))
def test_matches_sql(spark, sf, key):
    assert differences(QUERIES[key](spark, sf), connect(SMALL), SQL[key]) == []


PAGE = """<html><head><title>no</title><script>x = "</p>"</script></head><body><header class="site-header"><p>Site of things</p></header>
<nav><ul><li><a href=/>Home</a></li><li><a href=/b>Other</a></li></ul></nav>{open}<h1>A title &amp; more</h1>
<p>First paragraph, with <b>bold</b> words and a full stop. It goes on for a while, as text does, and says things.
<p>Second&nbsp;paragraph<br>has one more sentence, and then it ends. There is nothing more to be said about it here.</p>{close}
<div class="comments"><div class="comment"><p>I liked this page, thanks a lot.</p></div></div>
<form><label>Search</label><input><button>Go</button></form><footer>&copy; all rights</footer>"""
TEXT = ("A title & more\nFirst paragraph, with bold words and a full stop. It goes on for a while, as text does, and says things.\n"
        "Second paragraph has one more sentence, and then it ends. There is nothing more to be said about it here.")


def test_main_text(spark, sf):
    model = html.train(spark.read.parquet(f"{sf}/pages.parquet"))
    pages = spark.createDataFrame([
        (1, None, PAGE.format(open="<article>", close="</article>")),
        (2, "u", PAGE.format(open='<div class="post-content">', close="</div>")), (3, "u", None), (4, None, ""),
        (None, "u", "<p>loose"), (5, "u", "<div>" * 3000 + "deep" + "</div>" * 10), (6, "u", "a < b & c <p title=\"x>"),
    ], "page_id long, url string, html string")
    found = {r.page_id: r for r in html.main_text(pages, model).collect()}
    assert found[1].text == TEXT
    assert found[2].text == TEXT
    assert found[3].text == found[4].text == ""
    assert html.extract_pages(pages.limit(0)).count() == 0
    assert html.main_text(pages, None).count() == 7


@pytest.mark.parametrize("tag", "noscript svg math video audio object option select canvas template datalist".split())
def test_no_text_is_lost_to_tags_without_an_end(tag):
    def runs(page):
        return " ".join(" ".join(html.parse(page).text).split())

    for page in (f"<{tag}><article><p>one</p><p>two", f"<article><p>one <{tag}></p><p>two</p></article>",
                 f"<article><p>one</p><{tag}>two</{tag}></article>"):
        assert runs(page) == "one two", page
        tree = html.parse(page)
        if f"</{tag}>" not in page:
            assert not any(tree.bad[i] for i in range(len(tree.tag)) if tree.tag[i] in ("article", "p", "#"))
            assert html.decode(tree, np.where([x == 0 for x in html.plain_labels(tree)], 0.01, 0.99)).split() == ["one", "two"]


@pytest.mark.parametrize("page, text", [
    ('<p>a <span style="display:none">hid</span> b</p>', "a b"),
    ('<p>good text<sup class="ad">AD</sup> and more</p>', "good text and more"),
    ('<p>one<span class="ad">x</span>two</p>', "onetwo"),
    ('<p>one<span class="ad">x</span> <b class="advert">y</b>two</p>', "one two"),
    ('<p>one <i hidden>a <i>b</i> c</i>two <span>three</span></p><p>four</p>', "one two three\nfour"),
    ('<p>one <a class="sponsor" href="/x">two</a> three</p>', "one three"),
    ('<p>one <a href="/x">two</a> three<p>four', "one two three\nfour"),
])
def test_marked_elements_within_a_line(page, text):
    """Decoded with the plain labels: what stands in a marked element goes, the line stays one block."""
    tree = html.parse(f"<article>{page}</article>")
    labels = html.plain_labels(tree)
    assert html.decode(tree, np.array([0.5 if x is None else 0.001 + 0.998 * x for x in labels])) == text


@pytest.mark.parametrize("page", ["<div>" * 20_000 + "deep", "<li><ul>" + "<div>" * 5000 + "<li>x</li>" * 5000,
                                  "<span class=ad>" * 10_000 + "x" + "</span>" * 10_000, "<head>" * 20_000 + "x",
                                  "<p>" * 20_000 + "x", "<div><p>" * 10_000 + "</div>" * 10_000, "<select>" * 10_000])
def test_deep_pages_take_linear_time(page):
    begin = time.process_time()
    html.parse(page)
    assert time.process_time() - begin < 1.5


def labellings(tree):
    """Every labelling of nodes as kept (1), dropped (-1) or open (0) without contradictions."""
    children = defaultdict(list)
    for i, p in enumerate(tree.parent):
        children[p].append(i)

    def below(i, forced):
        for state in ([forced] if forced else [1, -1] if tree.tag[i] == "#" else [1, -1, 0]):
            for parts in itertools.product(*(list(below(c, state)) for c in children[i])):
                yield {i: state} | {k: v for part in parts for k, v in part.items()}

    return below(0, 0)


@pytest.mark.parametrize("page", ["<nav><p>a b</p><p>c d</p></nav><div><p>e</p></div>", "<div><div><p>a</p></div>b</div>c",
                                  '<p>a <i class="ad">b</i> c</p><p>d'])
def test_decoding_is_the_best_labelling(page):
    """Compared with all labellings; a kept or dropped node has only such descendants by the way they are made."""
    tree = html.parse(page)
    every = list(labellings(tree))
    runs = [i for i, t in enumerate(tree.tag) if t == "#"]
    for seed in range(40):
        chance = np.random.default_rng(seed).random(len(tree.tag)) * 0.98 + 0.01

        def value(states):
            # The page itself says nothing; an open node costs as much as a toss of a coin.
            return sum(0 if i == 0 else np.log({1: chance[i], -1: 1 - chance[i], 0: 0.5}[s]) for i, s in states.items())

        best = max(every, key=value)
        kept = [tree.text[i] for i in runs if best[i] == 1]
        assert html.decode(tree, chance).split() == " ".join(kept).split()


def renamed(page):
    """Attribute tokens that say nothing, and no tag that does."""
    page = re.sub(r"(class|id|role)=(\"[^\"]*\"|'[^']*'|[^\s>]+)", lambda m: f'{m[1]}="k{zlib.crc32(m[2].encode()) % 9}"', page)
    return re.sub(r"<(/?)(article|main|nav|aside|footer|header)\b", r"<\1div", page)


def test_pages_without_any_telling_mark(spark, sf):
    """Accuracy where neither tags nor attributes say what a part is: texts, links and places must."""
    rows = [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    model = html.train(spark.createDataFrame([(x,) for x in rows], "html string"))
    right = total = 0
    for page in rows[:60]:
        tree = html.parse(page)
        hidden = html.parse(renamed(page))
        assert len(tree.tag) == len(hidden.tag)
        chance = model.chance(html.features(hidden))
        for i, label in enumerate(html.plain_labels(tree)):
            if label is not None and tree.tag[i] == "#":
                total += len(tree.text[i])
                right += len(tree.text[i]) * ((chance[i] > 0.5) == label)
    assert right > 0.85 * total, right / total


def test_odd_pages(spark):
    """Repeated rows, nulls, a very long page, and columns of clashing names."""
    body = PAGE.format(open="<article>", close="</article>")
    long = "<article>" + "<p>One more sentence, as they come, and then it ends.</p>" * 20_000 + "</article>"
    pages = spark.createDataFrame([(1, "u", body, "t", 1), (1, "u", body, "t", 1), (2, None, None, None, None), (3, "u", long, "", 0)],
                                  "page_id long, url string, html string, text string, n_chars int")
    found = sorted(tuple(r) for r in html.extract_pages(pages).select("page_id", "text", "n_chars").collect())
    assert found[0] == found[1] and found[2] == (2, "", 0)
    # The only sort of page in the sample that is long: it trains too, and is extracted whole.
    assert found[3][2] > 0.9 * 20_000 * len("One more sentence, as they come, and then it ends.\n")


def test_urls(spark):
    pages = spark.createDataFrame([
        (1, "https://A.Example.NET/en/x?q#f"), (2, "http://example.net/fr/1"), (3, "http://notexample.com/de/"), (4, "HTTP://x.example.com/de/1#a"),
        (5, "http://b.org/fr/"), (6, None), (7, "no scheme"), (8, "http://?q"), (None, "http://b.org"), (9, "ftp://h"), (1, "http://b.org/fr/"),
    ], "page_id long, url string")
    good = spark.createDataFrame([(3, 1), (8, 0), (None, 1), (3, 0)], "page_id long, good int")
    found = sorted((tuple(r)[:4] for r in hosts.judge(pages, good).collect()), key=str)
    assert found == sorted([
        (1, "a.example.net", "/en/x", "example.net/en/"), (2, "example.net", "/fr/1", "net/"), (3, "notexample.com", "/de/", None),
        (4, "x.example.com", "/de/1", "example.com/de/"), (5, "b.org", "/fr/", "org/fr/"), (6, "", "", None), (7, "", "", None),
        (8, "", "", None), (None, "b.org", "", None), (9, "h", "", None), (1, "b.org", "/fr/", "org/fr/")], key=str)
    assert hosts.judge(pages.limit(0), good).count() == 0


def test_registered_domains(spark):
    hosts_of = {"a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "b.co.uk:8080": ("b.co.uk", "co.uk"),
                "x.com:80": ("x.com", "com"), "w.x.com": ("x.com", "com"), "com": ("com", "com"), "": ("", ""),
                "1.2.3.4": ("1.2.3.4", ""), "9.9.3.4:80": ("9.9.3.4", ""), "[::1]:80": ("[::1]", ""), "localhost": ("localhost", "localhost")}
    rows = spark.createDataFrame([(h,) for h in hosts_of], "host string")
    domain, suffix = hosts.domain_parts(F.col("host"))
    assert {r.host: (r.domain, r.suffix) for r in rows.select("host", domain.alias("domain"), suffix.alias("suffix")).collect()} == hosts_of


def test_pages_are_scanned_twice(spark, sf):
    """Once to count by host, once for the result; the levels are small staged tables."""
    found = hosts.op5_host_reputation(spark, sf)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("pages.parquet") == 1 and "NestedLoop" not in text


def test_long_urls_and_clashing_columns(spark):
    long = "http://a.net/" + "x" * 100_000
    pages = spark.createDataFrame([(1, long, "h", 1), (2, "http://b.com:1/de/", "i", 0)], "page_id long, url string, host string, n int")
    good = spark.createDataFrame([(1, 1)], "page_id long, good int")
    found = {r.page_id: r for r in hosts.judge(pages, good).collect()}
    assert (found[1].path, found[1].rule) == ("/" + "x" * 100_000, "net/") and found[2].host == "b.com:1"


ODD = [(0, [1.0, 0.5]), (20, None), (40, [1.0, None]), (60, [float("nan"), 1.0]), (None, [0.5, 0.5]), (1, [0.0, 0.0]),
       (2, [1.0, 0.5]), (2, [1.0, 0.5]), (3, [1.0, 2.0, 3.0]), (100, [-1.0, 0.25])]


def test_exact_search_of_odd_rows(spark):
    vectors = spark.createDataFrame(ODD, "vec_id long, embedding array<float>")
    found = [tuple(r) for r in exact_search.search(vectors, "vec_id % 20 = 0", k=3).collect()]
    assert sorted(f for f in found if f[0] == 0) == [(0, 1, 2, 64 * 64 + 32 * 32), (0, 2, 2, 5120), (0, 3, None, 3072)]
    assert {f[0] for f in found} == {0, 100}
    assert exact_search.search(vectors.limit(0), "vec_id % 20 = 0").count() == 0


def test_searches_with_clashing_columns(spark):
    vectors = spark.createDataFrame(
        [(i, [float(i % 7) - 3, 1.0, float(i)], "r", 1, 2.0, "l", 0) for i in range(200)],
        "vec_id long, embedding array<float>, row string, list int, distance double, pivot string, kind int")
    plain = vectors.select("vec_id", "embedding")
    for search, where in ((exact_search.search, "vec_id % 20 = 0"), (permutations.search, "vec_id % 100 = 0")):
        assert sorted(map(tuple, search(vectors, where).collect())) == sorted(map(tuple, search(plain, where).collect()))


def test_searches_equal_brute_force(spark):
    random = np.random.default_rng(8)
    x = random.normal(size=(1500, 12)).astype(np.float32)
    x[500:1000] = x[7]
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    whole = np.floor(64 * x.astype(float)).astype(int)
    scores = whole @ whole.T
    exact = {}
    for r in exact_search.search(vectors, "vec_id % 20 = 0").collect():
        exact.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    for q in range(0, 1500, 20):
        order = [i for i in np.lexsort((np.arange(1500), -scores[q])) if i != q][:20]
        assert [exact[q][k + 1] for k in range(20)] == [(i, scores[q, i]) for i in order]
    near = permutations.search(vectors, "vec_id % 100 = 0").collect()
    far = np.sqrt(((x[:, None].astype(float) - x[None].astype(float)) ** 2).sum(axis=2))
    hits = 0
    for q in range(0, 1500, 100):
        mine = sorted((r["rank"], r.vec_id, r.score) for r in near if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 11)) and all(m[2] == pytest.approx(far[q, m[1]], abs=1e-12) for m in mine)
        hits += len({m[1] for m in mine} & {i for i in np.lexsort((np.arange(1500), far[q])) if i != q and True} & set(
            [i for i in np.lexsort((np.arange(1500), far[q])) if i != q][:10]))
    assert hits >= 0.9 * 150


def test_permutations_of_odd_rows(spark):
    vectors = spark.createDataFrame(ODD, "vec_id long, embedding array<float>")
    found = permutations.search(vectors, "vec_id % 100 = 0").collect()
    assert {r.query_id for r in found} == {0, 100} and all(r.vec_id != 1 for r in found)
    assert permutations.search(vectors.limit(0), "vec_id % 100 = 0").count() == 0


def test_pipeline(spark, sf, odd_docs):
    packed = corpus_pipeline.run(spark, sf)
    assert packed.count() > 0
    docs = odd_docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, sf)
        assert docs.columns == odd_docs.columns, name


@pytest.mark.parametrize("name, module, function", [
    ("quality", "quality", "keep_good"), ("toxicity", "toxicity", "drop_toxic"), ("near_duplicates", "minhash", "keep_first"),
    ("packing", "packing", "pack_documents")])
def test_stages_of_the_pipeline_pass_texts_in_small_batches(spark, tmp_path, monkeypatch, name, module, function):
    """Every text reaches Python, whole, and no batch holds much more than 4 MB or one text."""
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    size, n = 500_000, 40
    spark.range(n).coalesce(1).select(F.repeat(F.lit("a"), size).alias("text")).write.parquet(f"{tmp_path}/texts")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.num_rows]), pa.array([sum(len(x.as_py()) for x in batch.column(0))])], ["rows", "chars"])

    monkeypatch.setattr(getattr(corpus_pipeline, module), function,
                        lambda docs, *more: docs.mapInArrow(sizes, "rows long, chars long"))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    try:
        step = dict(corpus_pipeline.STAGES)[name]
        found = step(spark, spark.read.parquet(f"{tmp_path}/texts"), str(tmp_path)).collect()
    finally:
        spark.conf.unset(key)
    assert sum(r.rows for r in found) == n and sum(r.chars for r in found) == n * size
    assert max(r.chars for r in found) <= (4 << 20) + size

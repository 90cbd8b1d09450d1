"""Operators that bring rows together: mixing, wrappers, top-k, and the pipeline."""

from __future__ import annotations

import re

import duckdb
import numpy as np
import pytest
from llm_fixtures import edge_docs, linked_components, make_docs, no_docs, story, words  # noqa: F401

import corpus_pipeline
from timepoint.llm import mixing, quality_rules, topk, wrappers
from timepoint.llm.queries import CHECKS, QUERIES

SMALL = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- mixing


def plain_targets(sizes, most=3):
    """Targets by source as the contract words it: share, stop, reshare until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    bound = {s: most * sizes[s] for s in sizes}
    stopped, total = set(), sum(sizes.values())
    while True:
        free = [s for s in sizes if s not in stopped]
        left = total - sum(bound[s] for s in stopped)
        target = {s: bound[s] for s in stopped} | {
            s: left * weight[s] / sum(weight[x] for x in free) for s in free
        }
        above = {s for s in free if target[s] > bound[s]}
        if not above:
            return target
        stopped |= above


@pytest.fixture(scope="module")
def many_docs(make_docs):
    rng = np.random.default_rng(4)
    texts = [story(i, int(n)) for i, n in enumerate(rng.integers(0, 120, 900))]
    sources = rng.choice(["a", "B", "é", "z", None, "small", "c"], 900, p=[0.4, 0.2, 0.1, 0.1, 0.1, 0.01, 0.09])
    return make_docs(texts, sources=sources.tolist())


def test_mixing_meets_its_targets(many_docs):
    rows = mixing.mix(many_docs).collect()
    source = {r.doc_id: r.source for r in many_docs.collect()}
    sizes, taken, target = {}, {}, {}
    for r in rows:
        s = source[r.doc_id]
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        target[s] = r.target
        assert r.taken in [k * r.size for k in range(4)]
    assert len(rows) == 900 and all(r.source_size == sizes[source[r.doc_id]] for r in rows)
    expected = plain_targets(sizes)
    assert target == pytest.approx(expected)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 120
    assert expected["small"] == 3 * sizes["small"] == taken["small"]


def test_mixing_is_the_same_again(many_docs):
    first = {r.doc_id: r.copies for r in mixing.mix(many_docs).collect()}
    again = {r.doc_id: r.copies for r in mixing.mix(many_docs.repartition(7)).collect()}
    other = {r.doc_id: r.copies for r in mixing.mix(many_docs, seed=99).collect()}
    assert first == again != other


def test_mixing_is_fair(make_docs):
    docs = make_docs([story(i, 10) for i in range(40)], sources=["a", "b"] * 20)
    copies = np.mean([[r.copies for r in mixing.mix(docs, seed=s).filter("target > source_size").collect()] for s in range(12)])
    assert copies == pytest.approx(10 / 7, abs=0.05)


def test_mixing_edge_rows(edge_docs, no_docs):
    rows = mixing.mix(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert all(r.taken == 0 and r.copies == 0 for r in rows if r.size == 0)
    mixed = mixing.mixed_documents(edge_docs)
    assert mixed.columns == edge_docs.columns
    assert mixed.count() == sum(r.copies for r in rows)
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


def test_mixing_runs_no_python(many_docs):
    plan = mixing.mixed_documents(many_docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---------------------------------------------------------------- wrappers

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script>
</head><body><header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a><li>Shop</ul></nav>
<div class="cookie-notice">We use cookies</div><!-- ad --><div class="ad">Buy %d</div>
<article class=post><h1>Title&nbsp;%d &amp; more</h1><p>First <b>bold</b>  line<br>two
<p>Second &lt;p&gt; &eacute; <a href="y">link</a></p>%s<form>Name</form><script>x("<p>no</p>")</script>
<ul><li>one</li><li>two</li></ul><section class="comments"><p>Nice!</p></section></article>
<aside>Related</aside><footer>&copy; x</footer></body></html>"""


def expected(i, extra=""):
    return f"Title {i} & more\nFirst bold line two\nSecond <p> é link\n{extra}one\ntwo"


def test_main_text_of_pages(spark):
    rows = [(i, f"http://h{i % 2}.org/{i}", PAGE % (i, i, "<p>Third</p>" * (i % 3))) for i in range(9)]
    rows += [
        (9, None, None),
        (10, "http://h0.org/e", ""),
        (11, "rel/ative", "<p>Plain <b>text"),
        (12, "http://h1.org/cut", (PAGE % (12, 12, ""))[:620]),
        (13, "http://one.net/", "a < b & c <nav>menu</nav> d"),
        (0, "http://h0.org/0", PAGE % (0, 0, "")),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    pages = pages.selectExpr("*", "'x' AS host", "'y' AS text", "'z' AS way")
    found = wrappers.main_texts(pages).collect()
    assert len(found) == len(rows)
    texts = {r.page_id: r.text for r in found}
    for i in range(9):
        assert texts[i] == expected(i, "Third\n" * (i % 3))
    assert texts[9] == texts[10] == "" and texts[11] == "Plain text"
    assert texts[12].startswith("Title 12 & more\nFirst bold line two")
    assert texts[13] == "a < b & c\nd"
    assert all(r.n_chars == len(r.text) for r in found)
    assert wrappers.main_texts(pages.limit(0)).count() == 0


def test_hosts_without_article_tags():
    page = "<body><div class=top><p>{0}</p></div><div class=text><p>{1}</p><p>{2}</p></div></body>"
    pages = [page.format("Menu", story(i, 30), story(i + 50, 30)) for i in range(4)]
    whole = wrappers.pattern(wrappers.parse(pages[0]))
    for p in pages[1:]:
        whole = wrappers.align(whole, wrappers.pattern(wrappers.parse(p)))
    way = wrappers.main_place(whole)
    assert way == ["body", "div.text"]
    assert wrappers.main_text(pages[2], way) == f"{story(2, 30)}\n{story(52, 30)}"


def test_raw_text_ends_with_its_element():
    for tag in ("<svg-icon name=x></svg-icon>", "<title-bar></title-bar>", "<svg class='i'/>", "<svg/>"):
        page = f"<article><p>One</p>{tag}<p>Two</p></article>"
        assert wrappers.main_text(page, ["article"]) == "One\nTwo"
    assert wrappers.main_text("<article>a<svg x><p>no</p></svg >b</article>", ["article"]) == "ab"


@pytest.mark.parametrize(
    ("page", "expected_text"),
    [
        ("<body>{0}<br>{1}<blockquote><p>{2}</p></blockquote></body>", "{0} {1}\n{2}"),
        ("<body><div class=x><p>{2}</p><ul><li>{0}</li><li>{1}</li></ul></div></body>", "{2}\n{0}\n{1}"),
        ("<body><div class=lead><p>{2}</p></div><div class=text><p>{0}</p><p>{1}</p></div></body>", "{2}\n{0}\n{1}"),
        ("{2}<div><p>{0}</p><p>{1}</p></div>", "{2}\n{0}\n{1}"),
    ],
)
def test_nothing_beside_the_place_is_lost(page, expected_text):
    parts = [(story(i, 60), story(i + 50, 60), story(i + 90, 6)) for i in range(4)]
    pages = [page.format(*x) for x in parts]
    way = wrappers.main_place(aligned(*pages))
    assert wrappers.main_text(pages[1], way) == expected_text.format(*parts[1])


@pytest.mark.parametrize(
    "page",
    [
        "<div class='content with-sidebar'><article><p>{0}</p></article></div>",
        "<div class='sidebar'><article><p>{0}</p></article></div><div class=sidebar-left>no</div>",
        "<div class='post category-social tag-advertising'><p>{0}</p></div>",
        "<article><div class='ad-free'><p>{0}</p></div><div class=ad_box>no</div></article>",
        "<form runat=server><div><p>{0}</p></div><div class=widget>no</div></form>",
        "<form><main><p>{0}</p><form>no</form></main></form>",
        "<form><article><p>{0}</p></article><div class=comments><article>no</article></div></form>",
    ],
)
def test_marks_do_not_take_the_article(page):
    pages = [page.format(story(i, 40)) for i in range(4)]
    way = wrappers.main_place(aligned(*pages))
    assert wrappers.main_text(pages[1], way) == story(1, 40)


def shape(items):
    return [[k or shape(inner), q] for k, q, _, _, _, inner in items]


def aligned(*pages):
    whole = None
    for p in pages:
        own = wrappers.pattern(wrappers.parse(p))
        whole = own if whole is None else wrappers.align(whole, own)
    return whole


def test_alignment_makes_options_and_repeats():
    assert shape(aligned("<h1>a</h1><p>b</p>", "<h1>a</h1><h2>c</h2><p>b</p>")) == [
        ["h1", "1"],
        ["h2", "?"],
        ["p", "1"],
    ]
    assert shape(aligned("<p>a</p><p>b</p>", "<p>a</p>")) == [["p", "+"]]
    assert shape(aligned("<p>a</p><ul></ul><p>b</p>")) == [[[["p", "1"], ["ul", "?"]], "+"]]
    ((group, quantifier),) = shape(aligned("<p>a</p><ul></ul>", "<ul></ul><p>b</p>"))
    assert quantifier == "+" and sorted(k for k, _ in group) == ["p", "ul"]


def test_a_wrapper_does_not_grow_with_its_pages():
    rng = np.random.default_rng(1)
    tags = ["p", "ul", "h2", "table", "pre"]
    pages = ["".join(f"<{t}>x</{t}>" for t in rng.choice(tags, 30)) for _ in range(60)]
    some, whole = aligned(*pages[:20]), aligned(*pages)
    assert len(repr(shape(whole))) <= 2 * len(repr(shape(some))) < 500


# ---------------------------------------------------------------- top-k


def plain_top_k(vectors, k, every):
    out = []
    for q, x in vectors:
        if q % every:
            continue
        scores = sorted((-int(x @ y), i) for i, y in vectors if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("shard", [16, 100, 8192])
def test_top_k_equals_brute_force(spark, shard):
    rng = np.random.default_rng(shard)
    x = rng.normal(size=(600, 8))
    x[100:300] = x[100]  # one vector very often
    x[400:420] = 0
    rows = [(i, [float(v) for v in x[i]]) for i in range(600)]
    odd = [(1000, None), (1050, [1.0, None]), (1100, [float("nan")] * 8), (None, [1.0] * 8), (1150, [float("inf")])]
    frame = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>").selectExpr("*", "1 AS shard", "2 AS v")
    found = sorted(tuple(r) for r in topk.top_k(frame, shard=shard, block=5).collect())
    assert found == plain_top_k([(i, np.floor(256 * x[i]).astype(int)) for i in range(600)], 5, 50)


def test_top_k_of_few_and_uneven_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0]), (2, []), (50, [float(1 << 22)] * 2)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = sorted(tuple(r) for r in topk.top_k(frame).collect())
    big = (1 << 22) * 256
    assert found == [
        (0, 1, 50, 256 * big + 512 * big),
        (0, 2, 1, 256 * 256),
        (0, 3, 2, 0),
        (50, 1, 0, 256 * big + 512 * big),
        (50, 2, 1, 256 * big),
        (50, 3, 2, 0),
    ]
    assert topk.top_k(frame.limit(0)).count() == 0


def test_blocks_of_queries_are_not_broadcast(spark):
    """A block stands there once for every shard, which no size measured before tells."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(rng.normal(size=(600, 8)))]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), shard=50, block=5)
    assert len(found.collect()) == 60
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


# ---------------------------------------------------------------- pipeline and checks


def test_pipeline_stages(make_docs, spark, tmp_path_factory):
    passage = story("p", 70)
    texts = [story(i, 60 + 9 * i) for i in range(30)]
    texts += [texts[3], texts[4] + " tail", "too short", "spam*** eggs$$$ " * 40, None]
    texts += [f"{story('m', 60)} {passage}", f"{passage} {story('n', 80)}"]
    folder = str(tmp_path_factory.mktemp("docs"))
    make_docs(texts).write.parquet(f"{folder}/documents.parquet")
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules",
        "near_dedup",
        "substring_dedup",
        "source_mix",
        "packing",
    ]
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        assert docs.columns == columns or k == 4
        kept.append(docs.collect())
    ids = [sorted(r.doc_id for r in rows) for rows in kept]
    passed = [
        i for i, t in enumerate(texts)
        if quality_rules.measure(t)[0] >= 50 and "***" not in (t or "")
    ]
    assert ids[0] == passed
    groups = linked_components({i: texts[i] for i in passed})
    assert ids[1] == sorted(set(groups.values())) and 30 not in ids[1]
    assert ids[2] == ids[1]
    cut = {r.doc_id: r.text for r in kept[2]}
    assert words(cut[36]) == words(story("n", 80)) and cut[35] == texts[35]
    assert set(ids[3]) <= set(ids[2]) and len(ids[3]) > 0
    lengths = {}
    for r in kept[4]:
        lengths[r.sequence_id] = lengths.get(r.sequence_id, 0) + r.length
    assert max(lengths.values()) <= 2048 and set(ids[4]) == set(ids[3])
    final = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, final.select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted(
        (r.doc_id, r.piece, r.length, r.ids_crc32) for r in kept[4]
    )


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_sql_checks(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    wanted = con.execute(CHECKS[name])
    columns = [c[0] for c in wanted.description]
    expected = sorted(map(repr, wanted.fetchall()))
    frame = QUERIES[name](spark, SMALL)
    assert sorted(frame.columns) == sorted(columns)
    assert sorted(repr(tuple(r)) for r in frame.select(*columns).collect()) == expected

from __future__ import annotations

import html
import re

import numpy as np
import pytest

from railwatch.llm import decontaminate, html_text
from railwatch.llm import text as T
from railwatch.llm.queries import QUERIES
from tests.llm.conftest import SF

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1><p>Words of a slogan.</p></header>
<nav><a href=x>Home</a></nav><main><article><h1>Title &amp; more</h1><p>First <b>bold</b>&nbsp;text, a <a href=y>link</a>.
<p>Second<br>line<aside class="related"><p>Read this related piece, too, if you like</p></aside><ul><li>one<li>two</ul>
<div class="ad"><p>Buy now this great product at once</p></div><blockquote>quote &lt;x&gt;</blockquote>
<section id="comments"><h2>Comments</h2><p>I liked it very much, many thanks to you</p></section></article></main>
<form><label>Name</label></form><div class="cookie-notice">We use cookies</div><footer>foot</footer>
<script>var x = "<p>no</p>"</script></body></html>"""


@pytest.fixture(scope="module")
def model(spark):
    return html_text.fit(spark.read.parquet(f"{SF}/pages.parquet"))


def plain(page):
    """The given pages have one article of headings and paragraphs."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = (" ".join(html.unescape(re.sub(r"</?b>|<br>", " " if "br" in b else "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner.replace("<br>", " ")))
    return "\n\n".join(b for b in blocks if b)


def test_given_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = QUERIES["op9_html_extraction"](spark, SF).collect()
    assert {r.page_id: r.text for r in found} == {k: plain(v) for k, v in pages.items()}
    assert all(r.n_chars == len(r.text) for r in found)


def test_page_with_other_parts(model):
    out = html_text.extract([PAGE], model)[0]
    assert out == "Title & more\n\nFirst bold text, a link.\n\nSecond line\n\none\n\ntwo\n\nquote <x>"


@pytest.mark.parametrize("n", [30, 300])
@pytest.mark.parametrize("kind", ["ul", "ol"])
def test_long_list_in_an_article(model, n, kind):
    items = [f"item {i} of some words" for i in range(n)]
    listed = f"<{kind}>" + "".join(f"<li>{t}</li>" for t in items) + f"</{kind}>"
    menu = "<ul>" + "<li><a href=x>Home</a></li>" * n + "</ul>"
    page = f"<html><body><nav>{menu}</nav><article><h1>Head</h1><p>Some words of text.</p>{listed}</article></body></html>"
    assert html_text.extract([page], model)[0] == "\n\n".join(["Head", "Some words of text.", *items])


def test_learned_class_words_decide():
    page = '<body><div class="zzbox"><p>Buy this</p></div><article><p>Some words.</p><p>More.</p></article></body>'
    model = html_text.Model(html_text.train(iter([page] * 100)))
    inside = '<body><article><p>Some words.</p><div class="zzbox">Buy this</div><p>More.</p></article></body>'
    assert html_text.extract([inside], model)[0] == "Some words.\n\nMore."


def test_odd_pages(spark, model):
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    rows = [(1, None), (2, ""), (3, "<p>"), (4, "</p><!-- x"), (5, "a < b & c"), (6, deep), (7, "<article>" + "<p>word word</p>" * 20_000), (7, "<script>x")]
    pages = spark.createDataFrame([(i, "u", h, "t") for i, h in rows], "page_id long, url string, html string, text string")
    out = html_text.extract_pages(pages, model).collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    texts = {r.page_id: r.text for r in out if r.page_id != 7}
    assert texts[1] == texts[2] == texts[3] == ""
    assert max(r.n_chars for r in out) == 20_000 * 11 - 2
    assert html_text.extract_pages(pages.limit(0), html_text.fit(pages.limit(0))).count() == 0


def test_marginals_are_those_of_all_labelings():
    random = np.random.default_rng(0)
    parent = np.array([-1, 0, 0, 1, 1, 2, -1, 6])
    odds, edge = random.normal(size=8), random.dirichlet([1, 1], 2)
    total, on = 0.0, np.zeros(8)
    for code in range(256):
        label = np.array([code >> i & 1 for i in range(8)])
        weight = np.exp((odds * label).sum()) * np.prod([edge[label[p], label[i]] for i, p in enumerate(parent) if p >= 0])
        total, on = total + weight, on + weight * label
    assert html_text.marginals(parent, odds, edge) == pytest.approx(on / total)


# --- decontamination ---


def words(text):
    return re.findall(r"[^\W_]+", text.lower())


def test_given_items(spark, given):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    found = {(r.doc_id, r.item_id) for r in QUERIES["op8_decontamination"](spark, SF).collect()}
    held = {
        (d, i.item_id) for d, t in given for i in items if f" {' '.join(words(i.text))} " in f" {' '.join(words(t))} "
    }
    assert held and held == found


def test_search_returns_all_above_the_threshold(spark, given):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    index = decontaminate.Index([r.item_id for r in items], [r.text for r in items])
    for _, text in given[:60]:
        h, _ = decontaminate._text_words([text])
        term = np.unique(index.find_terms(h))
        term = term[term >= 0]
        score = np.zeros(len(items))
        for t in term:
            score[index.item[index.at[t] : index.at[t + 1]]] += index.weight[index.at[t] : index.at[t + 1]]
        for threshold in (0.05, 0.2, 0.7):
            hits = dict(index.search(term.tolist(), threshold))
            assert sorted(hits) == np.flatnonzero(score >= threshold).tolist()
            assert all(hits[i] == pytest.approx(score[i]) for i in hits)


def test_possible_passages_lose_none(spark, given):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    index = decontaminate.Index([r.item_id for r in items], [r.text for r in items])
    import pyarrow as pa

    h, at = decontaminate.words(*T.utf8(pa.array([t for _, t in given])))
    term = index.find_terms(h)
    count = np.maximum(-(-np.diff(at) // index.stride) - 1, 1)
    possible = set(decontaminate.possible(index, term, at, count, 0.3).tolist())
    first = np.cumsum(count) - count
    for d in range(len(given)):
        for w in range(int(count[d])):
            some = np.unique(term[at[d] + w * index.stride : min(at[d] + (w + 2) * index.stride, at[d + 1])])
            if index.search(some[some >= 0].tolist(), 0.3):
                assert first[d] + w in possible


def test_items_and_passages(spark):
    question = "Which of the seven rivers that cross the old northern province was dammed first in the last century?"
    item = f"{question} The Alder, in nineteen hundred and four."
    filler = " ".join(f"filler{i % 97}" for i in range(5000))
    rows = [
        (1, f"{filler} {item} {filler}"),
        (2, f"{filler} {item.upper().replace(',', ' -- ')} {filler}"),
        (3, f"{filler} {question} {filler}"),
        (4, filler),
        (5, None),
        (6, ""),
        (6, item),
        (None, item),
    ]
    docs = spark.createDataFrame([(d, t, 1.0, 3) for d, t in rows], "doc_id long, text string, score double, item_id int")
    items = spark.createDataFrame([(9, item), (8, item), (7, ""), (6, None), (5, " ")], "item_id long, text string")
    for index_bytes in (32 << 20, 60):
        found = decontaminate.contaminated(docs, items, index_bytes=index_bytes).collect()
        pairs = sorted(((r.doc_id, r.item_id) for r in found), key=repr)
        assert pairs == sorted([(d, i) for d in (1, 2, 6, None) for i in (8, 9)], key=repr)
        clean = decontaminate.drop_contaminated(docs, items, index_bytes=index_bytes)
        assert sorted(r.doc_id for r in clean.collect()) == [3, 4, 5, 6] and clean.columns == docs.columns
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0


def test_hits_do_not_depend_on_the_number_of_indexes(spark):
    """Words that are rare in one index and common in all: scores and hits are those of a single one."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    tail = "and what was written there in the common words of all the others was read again by nobody"
    common = [(10_000 + i, f"{'north' if i % 2 else 'south'} gate {i} {tail}") for i in range(24)]
    passage = [(900_001, f"x y z {common[3][1]} z y x"), (900_002, f"gate 5 {tail}"), (900_003, f"south {tail}")]
    items = items.unionByName(spark.createDataFrame(common, items.schema))
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(passage, "doc_id long, text string"))
    total = items.selectExpr("sum(octet_length(text))").first()[0]
    found = []
    for shards in (1, 2, 7):
        size = -(-total // shards)
        assert len(list(decontaminate._indexes(items, size))) == shards
        rows = decontaminate.contaminated(docs, items, index_bytes=size).collect()
        found.append(sorted((r.doc_id, r.item_id, round(r.score, 9), r.question_overlap, r.answer_overlap) for r in rows))
    assert found[0] == found[1] == found[2]
    assert any(d == 900_001 and i == 10_003 for d, i, *_ in found[0])


@pytest.mark.parametrize("index_bytes", [32 << 20, 60])
def test_items_without_an_id_and_with_the_same(spark, index_bytes):
    text = "The bridge over the lower river was closed for repairs in the spring of that year. By whom? The council."
    other = "No lamp on the northern shore was ever lit again after the great storm had passed. Why? There was no oil."
    items = spark.createDataFrame([(None, text), (None, other), (4, text), (4, other), (3, text)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"a b {text} c"), (2, f"{text} {other}"), (3, "a b c")], "doc_id long, text string")
    got = decontaminate.contaminated(docs, items, index_bytes=index_bytes).collect()
    ids = sorted(((r.doc_id, r.item_id) for r in got), key=repr)
    assert ids == sorted([(1, None), (1, 3), (1, 4), (2, None), (2, None), (2, 3), (2, 4), (2, 4)], key=repr)
    assert [r.doc_id for r in decontaminate.drop_contaminated(docs, items, index_bytes=index_bytes).collect()] == [3]

import math
from collections import Counter

import numpy as np
import pytest

from sparkroute.llm import quality_classifier
from sparkroute.llm.html_extraction import extract, fit
from sparkroute.llm.piece_lattice import vocabulary
from sparkroute.llm.quality_classifier import pooled
from sparkroute.llm.queries import PIECE_MODEL, QUERIES
from sparkroute.llm.sentencepiece_sampling import decode, encode, sampled


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    scored = QUERIES["op6_quality_classifier"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").select("predicted", "quality", "score").collect()
    assert sum(r[0] == r[1] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r[2] <= 1 for r in rows) and scored.count() == 1000


def test_classifier_edges(spark):
    rows = [(1, None), (2, ""), (3, "word " * 20_000), (3, "word " * 20_000), (None, "x")]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    for labels in (none, spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 0)], "doc_id long, quality int")):
        out, name = quality_classifier.score(docs, quality_classifier.fit(docs, labels))
        assert name != "score" and len({r[name] for r in out.collect() if r["doc_id"] == 3}) == 1
        assert out.where(f"{name} between 0 and 1").count() == 5
    empty, _ = quality_classifier.score(docs.limit(0), quality_classifier.fit(docs.limit(0), none))
    assert empty.count() == 0


def test_pooling():
    got = pooled(np.array([1.0, 0.0, 2.0, 1.0, 3.0]), np.array([1.0, 1, 1, 3, 1]))
    assert np.allclose(got, [0.5, 0.5, 1.25, 1.25, 3])


def segmentations(text, pieces):
    if not text:
        yield ()
    for n in range(1, len(text) + 1):
        if text[:n] in pieces:
            yield from ((pieces[text[:n]], *rest) for rest in segmentations(text[n:], pieces))


def test_samples_follow_the_distribution():
    vocab = vocabulary(PIECE_MODEL)
    pieces = {b.decode().replace(" ", "▁"): i for i, b in enumerate(vocab.bytes) if b and i not in set(vocab.byte_ids.tolist())}
    ways = list(segmentations("▁ab▁the", pieces))
    weight = [math.prod(vocab.weight[list(w)]) for w in ways]
    chance = {w: x / sum(weight) for w, x in zip(ways, weight, strict=True)}
    n = 20_000
    drawn = []
    for has, ids, sizes, log_prob, inclusion in sampled(PIECE_MODEL, ["ab the"] * n, np.arange(n), 2):
        assert has.all() and ((inclusion > 0) & (inclusion <= 1)).all()
        ends = np.cumsum(sizes)
        drawn.append([tuple(ids[e - s : e].tolist()) for e, s in zip(ends, sizes, strict=True)])
        assert np.allclose(log_prob[:99], [math.log(chance[w]) for w in drawn[-1][:99]])
    assert all(a != b for a, b in zip(*drawn, strict=True))
    pairs = Counter(zip(*drawn, strict=True))
    for a in ways:
        for b in ways:
            if a != b:
                want = chance[a] * chance[b] / (1 - chance[a])
                assert abs(pairs[a, b] / n - want) < 5 * math.sqrt(want / n) + 1e-4


def test_round_trips_and_edges(spark):
    texts = ["", None, "a", "  two  blanks ", "line\n\n\nline", "漢字 ▁ \U0001F600\u0000\ttab", "x" * 3000, "é" * 5, "a"]
    rows = [(i if i < 8 else 2, t, "p") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, samples string")
    got = encode(docs, PIECE_MODEL, k=3)
    out = sorted(got.collect(), key=lambda r: r["doc_id"])
    assert len(out) == len(texts) and all(r["decoded"] for r in out)
    for r in out:
        ids = [tuple(s["ids"]) for s in r["samples"]]
        assert len(ids) == len(set(ids)) and 1 <= len(ids) <= 3
    assert out[2]["samples"] == out[3]["samples"]  # equal rows
    flat = got.selectExpr("doc_id", "samples[0].ids as ids")
    back = {r["doc_id"]: r["back"] for r in decode(flat, PIECE_MODEL, out="back").collect()}
    assert back == {i: t or "" for i, t, _ in rows}
    assert encode(docs.limit(0), PIECE_MODEL).count() == 0


PAGE = """<html><head><title>t</title><style>p{}</style></head><body>
<header class="top"><a href=/>Home</a> <a href=/x>Topics</a></header><div class="cookie-banner">We use cookies. <button>Yes</button></div>
<div class="sidebar"><h3>Read more</h3><ul><li><a href=1>First link</a><li><a href=2>Second link</a></ul></div>
<div id="content"><h1>A   title &amp; more</h1><p>The first paragraph has a <b>bold</b> word, some commas, and a full stop.
<p>A second one follows here, with a <a href=q>link</a> in the middle of the sentence.<br>Same block.</p>
<div class="ad">Buy this thing today!</div><blockquote>Somebody said this long ago, and it is quoted here.</blockquote>
<script>var a = "<p>no</p>";</script></div>
<section class="comments"><h2>Comments</h2><div class="comment"><p>I liked this article a lot, thank you for it.</p></div></section>
<form><label>Mail</label><input name=a></form><footer>&copy; 2020 All rights reserved</footer></body></html>"""
MAIN = ("A title & more\n\nThe first paragraph has a bold word, some commas, and a full stop.\n\nA second one follows here, with a link in "
        "the middle of the sentence. Same block.\n\nSomebody said this long ago, and it is quoted here.")


def test_extraction(spark, load_table):
    model = fit(load_table("pages"))
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<p>" * 3000 + "deep"), (4, "w", "a < b <!-- <p>")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string")
    got = extract(pages, model).collect()
    assert len(got) == 6 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["text"] for r in got if r["page_id"] == 1] == [MAIN, MAIN]
    assert [r["text"] for r in got if r["page_id"] in (2, None)] == ["", ""]
    assert extract(pages.limit(0), fit(pages.limit(0))).count() == 0


@pytest.mark.parametrize("name", ["nav", "ad"])
def test_no_boilerplate_on_table_pages(spark, sf, name):
    import html
    import re

    out = {r["page_id"]: r["text"] for r in QUERIES["op3_html_extraction"](spark, sf).collect()}
    tag = {"nav": r"<nav>.*?</nav>", "ad": r'<div class="ad">(.*?)</div>'}[name]
    for page in spark.read.parquet(f"{sf}/pages.parquet").collect():
        found = re.search(tag, page["html"], re.S)
        words = html.unescape(re.sub("<[^>]*>", " ", found.group(0))).strip()
        assert out[page["page_id"]] and (len(words) < 30 or words not in out[page["page_id"]])

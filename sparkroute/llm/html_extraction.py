"""HTML extraction: boosted trees over DOM nodes, decoded from the root down.

A model of boosted trees gives every block node the log odds that it leads to main text. The
decoding picks the tree of kept nodes with the greatest sum, in which no node is kept below a
dropped one; text is taken from the kept nodes, block by block, in the order of the page.
"""

from __future__ import annotations

import html as html_lib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkroute.llm.boosted_trees import BoostedTrees
from sparkroute.llm.common import python_workers
from sparkroute.llm.dom import N_FEATURES, Node, features, parse

SAMPLE_PAGES, MADE_PAGES, SEED = 200, 500, 3
SAMPLE_PAGE_BYTES = 256 << 10
_WRAPPERS = [
    ("article", ""), ("article", 'class="post"'), ("main", ""), ("main", 'id="content"'), ("div", 'class="content"'),
    ("div", 'id="main-content"'), ("div", 'class="post-body entry"'), ("section", 'class="story"'), ("div", 'class="article-text"'),
    ("div", 'itemprop="articleBody"'), ("td", 'class="body"'), ("div", ""), ("section", ""),
]
#: Regions around the main text: tag, attributes, kind of content.
_REGIONS = [
    ("nav", "", "links"), ("nav", 'class="main-menu"', "links"), ("div", 'id="nav"', "links"), ("ul", 'class="menu"', "items"),
    ("header", "", "title"), ("div", 'class="site-header"', "title"), ("header", 'class="masthead"', "links"),
    ("footer", "", "line"), ("div", 'class="footer"', "line"), ("div", 'id="site-footer"', "links"),
    ("aside", "", "prose"), ("aside", 'class="sidebar"', "links"), ("div", 'class="sidebar"', "prose"), ("div", 'id="right-rail"', "links"),
    ("div", 'class="ad"', "line"), ("div", 'class="advert"', "prose"), ("div", 'id="ad-slot"', "line"), ("section", 'class="sponsored"', "prose"),
    ("div", 'class="banner promo"', "line"), ("div", 'class="cookie-notice"', "prose"), ("div", 'id="cookie-consent"', "line"),
    ("div", 'class="notice"', "line"), ("dialog", "", "prose"), ("form", "", "form"), ("form", 'class="search"', "form"),
    ("div", 'class="newsletter"', "form"), ("section", 'class="subscribe"', "prose"), ("section", 'class="comments"', "remarks"),
    ("div", 'id="comments"', "remarks"), ("ol", 'class="commentlist"', "remarks"), ("div", 'class="reader-comments"', "remarks"),
    ("section", 'id="discussion"', "remarks"), ("div", 'class="related-posts"', "links"), ("div", 'class="share-buttons"', "items"),
    ("div", 'class="social"', "links"), ("ol", 'class="breadcrumbs"', "items"), ("div", 'class="pagination"', "links"),
    ("div", 'style="display:none"', "prose"),
]


def _words(rng: random.Random, bank: list[str], low: int, high: int) -> str:
    words = []
    while len(words) < low:
        words += rng.choice(bank).split() or ["word"]
    start = rng.randrange(max(1, len(words) - high))
    return html_lib.escape(" ".join(words[start : start + rng.randint(low, high)]))


def _region(rng: random.Random, bank: list[str]) -> str:
    tag, attributes, kind = rng.choice(_REGIONS)
    short = lambda: _words(rng, bank, 1, 4)
    if kind == "links":
        inner = "".join(f'<li><a href="/{i}">{short()}</a></li>' for i in range(rng.randint(2, 12)))
        inner = f"<ul>{inner}</ul>" if rng.random() < 0.7 else inner.replace("<li>", " ").replace("</li>", " ")
    elif kind == "items":
        item = "li" if tag in ("ul", "ol") else "div"
        inner = "".join(f'<{item}><a href="#">{short()}</a></{item}>' for _ in range(rng.randint(2, 6)))
    elif kind == "title":
        inner = f"<h1>{short()}</h1><p>{short()}</p>"
    elif kind == "line":
        inner = f"&copy; {_words(rng, bank, 3, 14)}"
        inner = inner if rng.random() < 0.6 else f"<p>{inner}</p>"
    elif kind == "form":
        inner = f"<label>{short()}</label><input name=q><p>{_words(rng, bank, 3, 12)}</p><button>{short()}</button>"
    elif kind == "remarks":
        inner = f"<h3>{short()}</h3>" + "".join(
            f'<div class="comment"><p class="author">{short()}</p><p>{_words(rng, bank, 5, 90)}</p></div>' for _ in range(rng.randint(1, 6)))
    else:
        inner = "".join(f"<p>{_words(rng, bank, 6, 60)}</p>" for _ in range(rng.randint(1, 3)))
    return f"<{tag} {attributes}>{inner}</{tag}>"


def _main(rng: random.Random, bank: list[str]) -> str:
    parts = []
    if rng.random() < 0.8:
        parts.append(f"<h1 data-keep=1>{_words(rng, bank, 2, 10)}</h1>")
    for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 14])):
        roll = rng.random()
        text = _words(rng, bank, *rng.choice([(1, 4), (4, 15), (15, 80), (60, 300)]))
        if roll < 0.68:
            parts.append(f"<p data-keep=1>{text}" + rng.choice(["</p>", "</p>", "", "<br>"]))
        elif roll < 0.76:
            parts.append(f"<h2 data-keep=1>{_words(rng, bank, 1, 8)}</h2>")
        elif roll < 0.84:
            items = "".join(f"<li data-keep=1>{_words(rng, bank, 2, 20)}</li>" for _ in range(rng.randint(2, 6)))
            parts.append(f"<ul>{items}</ul>")
        elif roll < 0.9:
            parts.append(f"<blockquote data-keep=1>{text}</blockquote>")
        elif roll < 0.95:
            parts.append(f"<div data-keep=1>{text}</div>")
        else:
            parts.append(f"<pre data-keep=1>{text}</pre>")
        if rng.random() < 0.08:
            parts.append(_region(rng, bank))
    if rng.random() < 0.2:
        parts.append(_region(rng, bank))
    tag, attributes = rng.choice(_WRAPPERS)
    inner = "".join(parts)
    if tag == "td":
        return f"<table><tr><td {attributes}>{inner}</td></tr></table>"
    return f"<{tag} {attributes}>{inner}</{tag}>"


def made_page(rng: random.Random, bank: list[str]) -> str:
    """A page of known structure around words of ``bank``; blocks of main text are marked."""
    before = "".join(_region(rng, bank) for _ in range(rng.randint(0, 5)))
    after = "".join(_region(rng, bank) for _ in range(rng.randint(0, 4)))
    body = before + _main(rng, bank) + after
    if rng.random() < 0.3:
        body = f'<div id="page" class="wrapper">{body}</div>'
    return f"<!DOCTYPE html><html><head><title>x</title></head><body>{body}</body></html>"


def _labelled(source: str) -> tuple[list[list[float]], list[int]]:
    nodes, blocks = parse(source)
    leads = {id(n) for n in nodes if n.keep}
    for n in reversed(nodes):
        if id(n) in leads and n.parent:
            leads.add(id(n.parent))
    return features(nodes, blocks), [int(id(n) in leads) for n in nodes]


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE_PAGES) -> BoostedTrees:
    """A model from ``MADE_PAGES`` pages of known structure, worded after the table's own pages.

    At most ``sample`` pages, chosen by a hash of their ids, lend their words; they are the only
    rows that come to the driver, whole. A chosen page above ``SAMPLE_PAGE_BYTES`` lends none.
    """
    place = F.xxhash64(F.lit(SEED), F.col(f"`{id_col}`"))
    known = pages.where(f"`{html_col}` is not null and `{id_col}` is not null").select(
        place.alias("place"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{html_col}`").alias("html"))
    ids = [row["id"] for row in known.select("place", "id").distinct().orderBy("place").limit(sample).collect()]
    known = known.where(F.octet_length("html") <= SAMPLE_PAGE_BYTES)
    bank = []
    for row in known.where(F.col("id").isin(ids)).groupBy("id").agg(F.min("html").alias("html")).collect() if ids else []:
        bank += [text for _, text in parse(row["html"])[1] if len(text) > 40]
    bank = sorted(bank) or ["one plain sentence, then another one. and some more words follow here"]
    rng = random.Random(SEED)
    x, y, weight = [], [], []
    for _ in range(MADE_PAGES):
        rows, labels = _labelled(made_page(rng, bank))
        x += rows
        y += labels
        weight += [1.0] * len(labels)
    return BoostedTrees().fit(np.array(x, float), np.array(y, float), np.array(weight))


def decoded(nodes: list[Node], odds: np.ndarray) -> list[bool]:
    """Which nodes are kept: the best sum of log odds with no kept node below a dropped one."""
    value = odds.tolist()
    for i in range(len(nodes) - 1, 0, -1):
        if value[i] > 0:
            value[nodes[i].parent.at] += value[i]
    kept = [False] * len(nodes)
    for i, node in enumerate(nodes):
        kept[i] = (value[i] > 0 or not i) and (not node.parent or kept[node.parent.at])
    return kept


def extract(pages: DataFrame, model: BoostedTrees, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: ``id_col``, ``url_col``, text and n_chars (code points).

    The main text of the whole page: its blocks, with white space as one space and character
    references decoded, joined by two newlines. Defined results: a null or empty html, and a page
    without main text, give the empty text; repeated rows come back each; null ids and urls are
    kept; other columns are not read; an empty table gives no rows.
    """
    python_workers(pages.sparkSession)
    rows = pages.select(F.col(f"`{id_col}`"), F.col(f"`{url_col}`"), F.col(f"`{html_col}`").alias("html_"))

    def run(batches):
        arrays = model.arrays()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                parsed = [parse(source or "") for source in part.column(2).to_pylist()]
                x = np.array([row for nodes, blocks in parsed for row in features(nodes, blocks)], float).reshape(-1, N_FEATURES)
                odds, first, texts = model.margins(x, arrays), 0, []
                for nodes, blocks in parsed:
                    kept = decoded(nodes, odds[first : first + len(nodes)])
                    first += len(nodes)
                    texts.append("\n\n".join(text for node, text in blocks if kept[node.at]))
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), sizes], [id_col, url_col, "text", "n_chars"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars long")

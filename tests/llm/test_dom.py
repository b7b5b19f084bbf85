import time

import pytest

from sparkroute.llm.dom import features, parse

RANK = 15


@pytest.mark.parametrize("n", [199, 200, 1000])
def test_siblings_have_their_rank_at_any_number(n):
    nodes, blocks = parse("<div>" + "".join(f"<p>text {i}</p>" for i in range(n)) + "</div>")
    rows = features(nodes, blocks)
    assert [row[RANK] for node, row in zip(nodes, rows, strict=True) if node.tag == "p"] == [i / n for i in range(n)]


@pytest.mark.parametrize("piece", ["<p '", '<p "', "<a", "<!", "</", "<svg>", "</script", "<p x='", "<p class="])
def test_long_broken_pages_are_read_in_linear_time(piece):
    source = "<div>" + piece * (1_000_000 // len(piece))
    begin = time.process_time()
    nodes, _ = parse(source)
    assert time.process_time() - begin < 20 and nodes[1].tag == "div"


def test_deep_pages_with_strange_end_tags_are_read_in_linear_time():
    begin = time.process_time()
    nodes, blocks = parse("<div>" * 50_000 + "</section>x" * 50_000)
    assert time.process_time() - begin < 20 and len(nodes) == 50_001 and len(blocks) == 50_000


@pytest.mark.parametrize("source,texts", [
    ("<p>a <svg>b<p>c", ["a b", "c"]), ("<p>a<script>b<p>c", ["a"]), ("<p>a<svg><p>b</svg>c", ["ac"]),
    ("<p title='>'>a", ["a"]), ("<p>it's 1 < 2 <b>x</b>", ["it's 1 < 2 x"]), ("<p>a</p x'>b", ["a", "b"]),
])
def test_borders_of_tags(source, texts):
    assert [t for _, t in parse(source)[1]] == texts

import math
from collections import Counter

import numpy as np
import pytest
from test_models import segmentations

from sparkroute.llm.piece_lattice import vocabulary
from sparkroute.llm.queries import PIECE_MODEL
from sparkroute.llm.sentencepiece_sampling import sampled


def exact(chance, k):
    """Chance of each segmentation at each of ``k`` places, drawn without replacement."""
    places = [Counter() for _ in range(k)]

    def draw(left, taken, p, place):
        if place == k:
            return
        for w in left:
            q = p * chance[w] / (1 - taken)
            places[place][w] += q
            draw([v for v in left if v != w], taken + chance[w], q, place + 1)

    draw(list(chance), 0.0, 1.0, 0)
    return places


@pytest.mark.parametrize("text,k", [("ab the", 4), ("ab it", 5)])
def test_more_samples_follow_the_distribution(text, k):
    vocab = vocabulary(PIECE_MODEL)
    pieces = {b.decode().replace(" ", "▁"): i for i, b in enumerate(vocab.bytes) if b and i not in set(vocab.byte_ids.tolist())}
    ways = list(segmentations("▁" + text.replace(" ", "▁"), pieces))
    assert len(ways) > k
    weight = [math.prod(vocab.weight[list(w)]) for w in ways]
    chance = {w: x / sum(weight) for w, x in zip(ways, weight, strict=True)}
    n = 20_000
    drawn = []
    for has, ids, sizes, _, _ in sampled(PIECE_MODEL, [text] * n, np.arange(n), k):
        assert has.all()
        ends = np.cumsum(sizes)
        drawn.append([tuple(ids[e - s : e].tolist()) for e, s in zip(ends, sizes, strict=True)])
    assert all(len(set(found)) == k for found in zip(*drawn, strict=True))
    for got, want in zip(drawn, exact(chance, k), strict=True):
        seen = Counter(got)
        for w in ways:
            assert abs(seen[w] / n - want[w]) < 5 * math.sqrt(want[w] / n) + 1e-4


def test_long_word_and_short_word_levels_agree():
    """A word of 300,000 characters ends in seconds; its probabilities are those of the same word among others."""
    rng = np.random.default_rng(5)
    word = "".join(rng.choice(list("abcdefghij"), 300_000))
    (has, ids, sizes, log_prob, _), second = list(sampled(PIECE_MODEL, [word], np.array([3]), 2))
    table = vocabulary(PIECE_MODEL).bytes
    for ranked in (ids, second[1]):
        assert b"".join(table[i] for i in ranked)[1:].decode() == word
    assert has.all() and second[0].all() and list(ids) != list(second[1]) and np.isfinite(log_prob).all()
    short = [word[:40], word[40:90]]
    alone = [next(sampled(PIECE_MODEL, [w], np.array([9]), 1)) for w in short]
    among = next(sampled(PIECE_MODEL, [*short, *[word[i : i + 60] for i in range(90, 900, 60)]], np.full(16, 9)[: 2 + 14], 1))
    ends = np.cumsum(among[2])
    for i, one in enumerate(alone):
        assert list(one[1]) == list(among[1][ends[i] - among[2][i] : ends[i]])
        assert abs(one[3][0] - among[3][i]) < 1e-6

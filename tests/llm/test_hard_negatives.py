import math
import random

import numpy as np
from conftest import plan_of

from sparkroute.llm import hard_negatives as hn

DDL = "vec_id long, embedding array<double>, label int, uid string, rank string"


def brute(rows, every, relabel=7, n_labels=10):
    """The same by comparing all pairs of rows; rows are (id, vector, label)."""
    kept = []
    for place, (i, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) or not math.isfinite(256 * x) for x in vector):
            continue
        if i is not None and i % relabel == 0:
            label = (label + 1) % n_labels
        kept.append((place, i, label, [math.floor(256 * x) for x in vector]))
    out = []
    for place, i, label, vector in kept:
        if i is None or i % every:
            continue
        scored = [(min(max(sum(a * b for a, b in zip(vector, v)), hn.LEAST), hn.MOST), j, lab, p)
                  for p, j, lab, v in kept if p != place and len(v) == len(vector)]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0, s[3]))
        for score, j, _, _ in [s for s in scored if s[2] == label][:5]:
            worse = [s for s in scored if s[2] != label and 80 * score <= 100 * s[0] <= 100 * score][:5]
            out += [(i, j, k, s[1], score, s[0]) for k, s in enumerate(worse, 1)]
    return sorted(out, key=str)


def found(spark, rows, every):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], DDL).coalesce(1)
    got = hn.hard_negatives(df, anchor_every=every)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(([r[n] for n in names] for r in got.collect()), key=lambda r: str(tuple(r)))


def check(spark, rows, every):
    got = [tuple(r) for r in found(spark, rows, every)]
    want = brute(rows, every)
    assert sorted(got, key=str) == want
    return want


def test_like_all_pairs(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        center = i % 4
        rows.append((i, [rng.gauss(0, 0.05) + (0.3 if k % 4 == center else 0) for k in range(19)], rng.randrange(3)))
    assert len(check(spark, rows, 20)) > 100


def test_odd_rows(spark):
    v = [0.5, 0.25, -0.125]
    rows = [(0, v, 1), (0, v, 1), (0, v, 3), (None, v, 1), (None, v, 2), (5, v, 1), (5, v, 1), (-100, v, 1), (7, v, 0), (14, None, 1),
            (1, v, None), (2, [0.5, None, 0.1], 1), (3, [0.5, float("nan"), 0.1], 1), (4, [float("inf"), 0.1, 0.1], 2), (100, [], 1),
            (8, [], 1), (9, [], 2), (200, [-0.5, -0.25, 0.125], 1), (11, [0.5, 0.25, -0.25], 4), (12, [0.5, 0.25], 1)]
    assert check(spark, rows, 100)
    assert found(spark, [], 100) == []


def test_scores_beyond_exact_doubles_and_bigint(spark):
    big, huge = 2.0**24, 2.0**70
    rows = [(0, [big, big + 1 / 256, 1.0], 1), (1, [big, big, 1.0], 1), (2, [big, big - 1 / 256, 1.0], 2), (3, [big, big, 3.0], 2),
            (100, [huge, huge, 0.0], 1), (4, [huge, 1.0, 0.0], 1), (5, [huge, 0.0, 5.0], 2), (6, [-huge, 0.0, 5.0], 2)]
    assert check(spark, rows, 100)


def test_hot_vector_and_ties(spark):
    rows = [(i, [0.25, 0.5], i % 3) for i in range(300)] + [(i, [0.25, 0.5 - i / 3000], i % 3) for i in range(300, 400)]
    random.Random(1).shuffle(rows)
    assert check(spark, rows, 50)


def test_bounds_hold_on_every_level():
    rng = np.random.default_rng(5)
    for dim in (1, 3, 4, 5, 64, 70):
        x, y = np.floor(rng.normal(0, 40, (30, dim))), np.floor(rng.normal(3, 40, (20, dim)))
        a, b = (hn.Block(hn._packed(np.arange(len(v)), np.zeros(len(v), bool), np.zeros(len(v), np.int64), np.arange(len(v)), v)) for v in (x, y))
        true = x @ y.T
        assert hn.levels(dim)[-1] == hn.FINE and hn.levels(dim)[0] >= dim
        for cut in hn.segments(dim):
            middle, reach = a.means[:, cut] @ b.means[:, cut].T, a.spreads[:, cut] @ b.spreads[:, cut].T + 1e-5 * np.outer(a.lengths, b.lengths)
            assert (true <= middle + reach).all() and (true >= middle - reach).all()


def test_bounds_spare_exact_scores():
    rng = np.random.default_rng(6)
    centers = rng.normal(0, 0.2, (8, 64))
    x = np.floor(256 * (centers[rng.integers(0, 8, 4000)] + rng.normal(0, 0.01, (4000, 64))))
    n = len(x)
    rows = hn.Block(hn._packed(np.arange(n), np.zeros(n, bool), np.zeros(n, np.int64), np.arange(n), x))
    best = hn.Best(hn.Block(hn._packed(np.arange(40), np.zeros(40, bool), np.zeros(40, np.int64), np.arange(40), x[:40])))
    assert best.add(rows) < 0.5 * 40 * n


def test_anchors_take_turns(spark, monkeypatch):
    monkeypatch.setattr(hn, "ANCHORS", 8)
    monkeypatch.setattr(hn, "HELD", 3)
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0.1, 0.3) for _ in range(6)], rng.randrange(3)) for i in range(500)]
    assert len(check(spark, rows, 5)) > 500  # 25 groups of anchors, three at a time


def test_only_anchors_are_broadcast(spark, monkeypatch):
    """However the sizes are estimated, what goes through the driver is one turn of anchors, not a copy for each group of rows."""
    sent, plain = [], hn._met

    def met(blocks, anchors, *rest):
        out = plain(blocks, anchors, *rest)
        plan = plan_of(out)
        sent.append((plan.count("BroadcastHashJoin"), plan.count("Generate"), plan.count("Exchange hashpartitioning")))
        return out

    monkeypatch.setattr(hn, "_met", met)
    rng = random.Random(9)
    check(spark, [(i, [rng.gauss(0, 0.3) for _ in range(4)], i % 3) for i in range(200)], 10)
    assert sent == [(1, 0, 0), (1, 0, 0)]

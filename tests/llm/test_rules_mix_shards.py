import math
from collections import Counter, defaultdict

import pytest

from sparkroute.llm.mixing import MAX_REPEAT, mix, taken_documents
from sparkroute.llm.quality_rules import quality_rules
from sparkroute.llm.queries import ORACLES, QUERIES
from sparkroute.llm.sharding import byte_splitters, shard_documents

COLUMNS = "doc_id long, text string, source string, quality string, row string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, "q", "r") for i, t, s in rows], COLUMNS)


def test_rules_agree_with_sql(spark, sf):
    from oracle import compare, connect

    _, problem = compare(spark, connect(sf), sf, QUERIES["op1_quality_rules"], ORACLES["op1_quality_rules"])
    assert not problem


def test_rules_edges(spark):
    plain = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None, "a"), (2, "", None), (3, plain, None), (4, plain, "a"), (4, plain, "a"), (5, "a b c " * 40, "a"),
            (6, "x\nx\n \nx | #", "b"), (7, "y" * 200_000, "b")]
    judged, name = quality_rules(docs_of(spark, rows))
    assert set(judged.columns) == {"doc_id", "text", "source", "quality", "row", name} and name != "quality"
    got = {r["doc_id"]: r[name] for r in judged.collect()}
    assert judged.count() == len(rows)
    assert [got[i]["kept"] for i in range(1, 8)] == [False, False, True, True, False, False, False]
    assert (got[5]["n_words"], got[5]["n_repeat_words"]) == (120, 120)
    assert (got[6]["n_symbols"], got[6]["n_dup_lines"], got[6]["word_chars"]) == (2, 1, 5)
    assert got[3]["host_docs"] == 2 and got[1]["host_docs"] == 4
    assert quality_rules(docs_of(spark, []))[0].count() == 0


def test_host_of_failures_is_rejected_but_a_small_one_is_not(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, "bad", "junk") for i in range(300)] + [(300, good, "junk")]
    rows += [(400 + i, good, f"s{i % 20}") for i in range(400)] + [(900, "bad", "tiny"), (901, good, "tiny")]
    judged, name = quality_rules(docs_of(spark, rows))
    kept = {r["doc_id"] for r in judged.where(f"{name}.kept").collect()}
    assert 300 not in kept and 901 in kept and len(kept) == 401


def highest_quotients(votes, seats):
    won = Counter()
    for _ in range(seats):
        won[max(votes, key=lambda s: (votes[s] / (2 * won[s] + 1), [-ord(c) for c in s]))] += 1
    return won


def targets_of(sizes):
    weight = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    capped = set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        total = sum(w for s, w in weight.items() if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else rest * weight[s] / total for s in sizes}
        more = {s for s in sizes if s not in capped and target[s] > 3 * sizes[s]}
        if not more:
            return target
        capped |= more


def test_mix_meets_targets(spark, load_table):
    docs = load_table("documents")
    mixed, name = mix(docs, shard_docs=7)
    rows = mixed.select("doc_id", "source", f"{name}.*").collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= MAX_REPEAT * r["size"]
    want = targets_of(sizes)
    for r in rows:
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-9)
    assert all(abs(taken[s] - want[s]) <= 16 for s in sizes)
    again = mix(docs.repartition(5), shard_docs=7)[0].select("doc_id", f"{name}.taken")
    assert sorted(again.collect()) == sorted((r["doc_id"], r["taken"]) for r in rows)


def test_apportionment_is_by_highest_quotients(spark):
    from pyspark.sql import functions as F

    from sparkroute.llm.mixing import apportion

    votes = {"a": 5300, "b": 2400, "c": 2400, "d": 900, "e": 11, "f": 0}
    df = spark.createDataFrame([("g", s, v) for s, v in votes.items()], "g string, s string, v long")
    for seats in (0, 1, 2, 7, 15, 100, 1234):
        got = {r["s"]: r["n"] for r in apportion(df, "v", F.lit(seats), ["g"], ["s"], "n").collect()}
        assert got == {s: highest_quotients(votes, seats)[s] for s in votes}, seats


def test_mix_edges_and_pieces(spark):
    rows = [(1, None, "a"), (2, " \n", "a"), (3, "one two three", None), (3, "one two three", None), (4, "v w x y z " * 30, "b"),
            (5, "q" * 100_000, "c")]
    mixed, name = mix(docs_of(spark, rows))
    got = mixed.select("doc_id", f"{name}.*").collect()
    assert len(got) == 6 and {r["taken"] for r in got if r["doc_id"] in (1, 2)} == {0}
    words = sum(r["taken"] for r in got)
    assert abs(words - 157) <= 4
    out = taken_documents(docs_of(spark, rows))
    assert out.columns == COLUMNS.replace(" long", "").replace(" string", "").split(", ")
    assert sum(len(r["text"].split()) for r in out.collect()) == words
    assert mix(docs_of(spark, []))[0].count() == 0 and taken_documents(docs_of(spark, [])).count() == 0


def test_shards_are_even_gapless_and_keep_groups(spark):
    rows = [(i * 7, f"text {i} " * (i % 50 + 1), "s") for i in range(4000)]
    rows += [(100_000 + i, "the same text in every copy", "s") for i in range(3000)]
    placed, name = shard_documents(docs_of(spark, rows))
    got = placed.select("doc_id", "text", f"{name}.*").collect()
    assert len(got) == 7000
    size, slots, where = Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        assert r["size"] == len(r["text"].encode()) + 1
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        where[r["text"]].add(r["shard"])
    assert sorted(size) == list(range(8)) and max(size.values()) < 1.01 * min(size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sum(len(s) > 1 for s in where.values()) <= 1


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(None, "a", "s"), (2, None, "s"), (2, None, "s"), (3, "ä" * 70_000, "s")]])
def test_shard_edges(spark, rows):
    placed, name = shard_documents(docs_of(spark, rows))
    got = placed.select("doc_id", f"{name}.*").collect()
    assert len(got) == len(rows)
    for shard in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_splitters_inside_one_hash(spark):
    keyed = spark.range(10_000).selectExpr("5L as h", "id * 3 as d", "id as u", "2L as size")
    splits = byte_splitters(keyed, 8)
    assert [abs(n - 1250 * (i + 1)) <= 5 for i, (_, _, _, n) in enumerate(splits)] == [True] * 7
    for h, d, _, n in splits:
        assert keyed.where(f"d < {d}").count() == n if h == 5 else n in (0, 10_000)


@pytest.mark.parametrize("of_hot", [lambda i: (None, "the same text again"), lambda i: (7, "the same text again")])
def test_shards_stay_even_with_a_third_of_rows_equal(spark, of_hot):
    rows = [(*of_hot(i), "s") if i % 3 == 0 else (i, f"text {i} of its own", "s") for i in range(9000)]
    placed, name = shard_documents(docs_of(spark, rows).repartition(6))
    got = placed.select(f"{name}.*").collect()
    size, slots = Counter(), defaultdict(list)
    for r in got:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    total = sum(size.values())
    assert len(got) == 9000 and sorted(size) == list(range(8))
    assert all(abs(s - total / 8) <= 0.002 * total for s in size.values())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())

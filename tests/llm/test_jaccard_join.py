import itertools
import random

import pytest

from sparkroute.llm.jaccard_join import jaccard_components


def brute(rows, percent=85, k=4):
    """The contract by definition: all pairs, then components."""
    def sets(text):
        words = [w for w in "".join(c if c not in "\t\n\x0b\x0c\r" else " " for c in _lower(text or "")).split(" ") if w]
        if len(words) < k:
            return {tuple(words)} if words else set()
        return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}

    items = [(i, sets(t)) for i, t in rows]
    root = {i: i for i, _ in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, a), (j, b) in itertools.combinations(items, 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            x, y = sorted((find(i), find(j)))
            root[y] = x
    return sorted((i, len(s), find(i)) for i, s in items)


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect())


@pytest.mark.parametrize("seed,vocabulary,percent,k", [(1, 2000, 85, 4), (2, 40, 85, 4), (3, 500, 80, 5)])
def test_equals_brute_force(spark, seed, vocabulary, percent, k):
    rnd = random.Random(seed)
    base = [[f"w{rnd.randrange(vocabulary)}" for _ in range(rnd.choice([5, 9, 12, 30, 80, 300]))] for _ in range(40)]
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for words in base:
        for _ in range(6):
            w = list(words)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
                w[rnd.randrange(len(w))] = f"x{rnd.randrange(50)}"
            if rnd.random() < 0.3:
                w += passage
            texts.append(" ".join(w))
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(jaccard_components(df, percent=percent, shingle=k)) == brute(rows, percent, k)


def test_large_group_of_near_copies(spark):
    rnd = random.Random(5)
    words = [f"w{rnd.randrange(900)}" for _ in range(200)]
    rows = []
    for i in range(150):
        w = list(words)
        w[rnd.randrange(200)] = f"own{i}"
        rows.append((i, " ".join(w)))
    rows.append((999, " ".join(words[:100])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(jaccard_components(df)) == brute(rows)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "a b c"), (7, "a  b\nc"), (8, "c b a"),
            (9, "ä Ä e f g"), (10, "ä ä e f g"), (11, "x" * 300_000), (12, "x" * 300_000)]
    df = spark.createDataFrame([(i, t, "s", "c") for i, t in rows], "doc_id long, text string, id string, component string")
    assert rows_of(jaccard_components(df)) == brute(rows)


def test_null_ids_repeated_rows_and_empty_table(spark):
    rows = [(None, "a b c d e"), (4, "a b c d e"), (4, "a b c d e"), (2, "q r s t u v")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(jaccard_components(df).collect(), key=str)
    assert sorted([(r[0], r[2]) for r in got], key=str) == sorted([(None, None), (4, 4), (4, 4), (2, 2)], key=str)
    assert jaccard_components(df.limit(0)).count() == 0

import hashlib

from pyspark.sql import functions as F

from sparkroute.llm.fingerprints import K, W, edited_fingerprints, winnowed


def by_definition(runs):
    """Rightmost minima of all windows, from (hash, position) pairs."""
    windows = [runs[i : i + W] for i in range(max(len(runs) - W + 1, 1))]
    out = []
    for w in windows:
        least = min(h for h, _ in w)
        best = max(p for h, p in w if h == least)
        if not out or out[-1] != (least, best):
            out.append((least, best))
    return list(dict.fromkeys(out))


def test_rightmost_minima(spark):
    text = "a b c d e f g h " * 9 + "tail one two three four " * 5 + "x" * 50
    df = spark.createDataFrame([(text,)], "t string")
    tokens = df.select(F.regexp_extract_all("t", F.lit(r"[^\x20\x09-\x0D]{1,12}"), F.lit(0))).first()[0]
    rows = [(i, *tokens[i : i + K]) for i in range(len(tokens) - K + 1)]
    hashed = spark.createDataFrame(rows, "i long, a string, b string, c string, d string").select("i", F.xxhash64("a", "b", "c", "d").alias("h"))
    runs = [(r["h"] >> 24, r["i"]) for r in hashed.orderBy("i").collect()]
    got = [(x >> 24, (1 << 24) - 1 - (x & ((1 << 24) - 1))) for x in df.select(winnowed(F.col("t"))).first()[0]]
    assert got == by_definition(runs)


def test_edited_texts_and_order(spark):
    rows = [(5, "eins zwei drei vier"), (9, None), (2, "ab" * 40), (7, "ß" * 10), (5, "eins zwei drei vier"), (None, "q r s")]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, chosen string, next_text string")
    got = edited_fingerprints(df).collect()
    assert len(got) == len(rows)
    order = [(9, ""), (7, "ß" * 10), (5, rows[0][1]), (5, rows[0][1]), (2, "ab" * 40), (None, "q r s")]
    want = []
    for i, (d, t) in enumerate(order):
        after, cut = order[(i + 1) % len(order)][1], len(t) // 3
        edited = t[: len(t) - cut] + after[:cut]
        want.append((str(d), len(t), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in got) == sorted(want)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert edited_fingerprints(df.limit(0)).count() == 0


def test_table_with_many_buckets(spark, load_table):
    import sparkroute.llm.fingerprints as m

    docs = load_table("documents")
    before, m.BUCKET_ROWS = m.BUCKET_ROWS, 9
    try:
        got = {r["doc_id"]: r for r in edited_fingerprints(docs).collect()}
    finally:
        m.BUCKET_ROWS = before
    texts = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), reverse=True)
    for i, (d, t) in enumerate(texts):
        after, cut = texts[(i + 1) % len(texts)][1], len(t) // 3
        assert got[d]["edited_sha256"] == hashlib.sha256((t[: len(t) - cut] + after[:cut]).encode()).hexdigest()
    near = [r["near_edited"] for r in got.values() if r["n_chars"] > 1000]
    assert sum(near) / len(near) > 0.3 > sum(r["near_next"] for r in got.values()) / len(got)

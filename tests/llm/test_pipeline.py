from corpus_pipeline import drop_near_copies

A, B, C = ("the quick brown fox jumps over lazy dogs", "seven other words stand here all alone", "yet one more text that nobody has copied")


def kept(spark, rows):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, row int")
    return sorted(((r["doc_id"], r["text"]) for r in drop_near_copies(spark, df, "").collect()), key=str)


def test_other_texts_of_a_repeated_id_stay(spark):
    assert kept(spark, [(3, A), (7, A), (7, B)]) == [(3, A), (7, B)]
    assert kept(spark, [(7, B), (7, A), (3, A), (7, A), (7, C), (9, C.upper())]) == [(3, A), (7, B), (7, C)]


def test_rows_without_an_id_take_part(spark):
    got = kept(spark, [(None, A), (None, A), (5, B), (None, B), (None, C), (None, None), (None, ""), (8, " "), (8, " "), (8, None)])
    assert got == sorted([(None, A), (5, B), (None, C), (None, None), (None, ""), (8, " "), (8, None)], key=str)


def test_unique_ids(spark):
    assert kept(spark, [(4, A), (2, A), (6, B), (9, None)]) == sorted([(2, A), (6, B), (9, None)], key=str)
    assert kept(spark, []) == []

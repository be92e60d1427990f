"""Queries without hits stay; one passage alone; image numbers."""

from tessera.operators import datasets as ds, evaluate as ev, retrieve as rt


def test_queries_without_hits_stay(spark):
    queries = spark.createDataFrame([(1, "one"), (2, "two")], "qid int, text string")
    hits = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "qid int, rk int, content string")
    assert sorted(tuple(r) for r in rt.context_record(hits, queries).collect()) == [(1, "a\nb", "one"), (2, "", "two")]
    got = spark.createDataFrame([(1, "x"), (1, "y")], "qid int, s string")
    found = ev.context_relevance(got, spark.createDataFrame([(1, "x"), (2, "z")], "qid int, s string"), queries, "s")
    assert sorted(tuple(r) for r in found.collect()) == [(1, 2, 1, 0.5), (2, 0, 0, 0.0)]


def test_one_passage_has_no_negatives(spark):
    rows = lambda n: spark.createDataFrame([(i, f"t{i}") for i in range(n)], "id int, text string")
    assert ds.negatives(rows(1), 3, 7, "id", "text").count() == 0
    assert ds.negatives(rows(0), 3, 7, "id", "text").count() == 0
    two = ds.negatives(rows(2), 3, 7, "id", "text").collect()
    assert len(two) == 6 and all(r.id != r.neg_key for r in two)


def test_images_keep_their_numbers(spark):
    queries = spark.createDataFrame([(1, "q")], "qid int, text string")
    hits = spark.createDataFrame([(1, 1, "image", " ", 0.9), (1, 2, "image", "b.png", 0.9), (1, 3, "image", "c.png", 0.001)], "qid int, rk int, kind string, content string, score double")
    row = rt.numbered_context(hits, queries).first()
    assert "(2) b.png" in row.context_str and "(1)" not in row.context_str and row.n_images == 1

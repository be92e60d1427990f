"""Values of merged relations, rows of communities, files by name."""

from tessera.operators import communities as cm, graph as gr
from tessera.sources import stores as st
from tessera.session import work_path


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_relation_values(spark):
    links = spark.createDataFrame([("a", "b", "x", 1, 0), ("a", "b", "x", 2, 0), ("a", "b", "y", 2, 0), ("a", "c", None, 3, 1)],
                                  "src string, tgt string, keyword string, doc_id int, pos int")
    assert rows(gr.relation_values(links, ["keyword"]), "src", "tgt", "keyword", "n") == [("a", "b", "x", 2), ("a", "b", "y", 1)]
    assert rows(gr.relation_values(links, ["doc_id", "pos"]), "src", "tgt", "doc_id", "pos", "n") == [
        ("a", "b", 1, 0, 1), ("a", "b", 2, 0, 2), ("a", "c", 3, 1, 1)]
    assert gr.relation_values(links.limit(0), ["keyword"]).count() == 0


def test_community_rows(spark):
    members = spark.createDataFrame([("a", 0, "a"), ("b", 0, "a"), ("c", 0, "a"), ("a", 1, "a"), ("b", 1, "a"), ("c", 1, "c")],
                                    "node string, level int, community string")
    relations = spark.createDataFrame([("a", "b", 2), ("b", "c", 1)], "src string, tgt string, weight int")
    mentions = spark.createDataFrame([("a", 1, 0), ("b", 1, 0), ("a", 1, 0), ("c", 2, 0), ("z", 9, 9)], "name string, doc_id int, pos int")
    assert rows(cm.community_relations(members, relations), "level", "community", "src", "tgt") == [
        (0, "a", "a", "b"), (0, "a", "b", "c"), (1, "a", "a", "b")]
    assert rows(cm.community_chunks(members, mentions), "level", "community", "doc_id", "pos", "n") == [
        (0, "a", 1, 0, 2), (0, "a", 2, 0, 1), (1, "a", 1, 0, 2), (1, "c", 2, 0, 1)]
    degree = gr.degrees(relations)
    table = {(r.level, r.community): (r.n_entities, r.n_relations, r.n_chunks, r.summary)
             for r in cm.community_table(members, relations, mentions, degree, 2).collect()}
    assert table == {(0, "a"): (3, 2, 2, "b a"), (1, "a"): (2, 1, 1, "b a"), (1, "c"): (1, 0, 1, "c")}


def test_names_that_collide_stay_apart(spark):
    long = "n" * 150
    given = [("a/b", "one"), ("a_b", "two\n\nlines\n"), ("a\\b", "three"), ("same", "x"), ("same", "y"), ("same", "y"), ("12", " padded "),
             ("empty", None), (None, "left out"), ("", "left out"), (long + "1", "l1"), (long + "2", "l2"), ("q=1?%:é", "signs")]
    df = spark.createDataFrame(given, "name string, text string")
    want = {(r["name"], r["value"]) for r in st.named_texts(df, "name", "text").collect()}
    assert sorted(v for _, v in want) == sorted(["one", "two\n\nlines\n", "three", "x", "y", "padded", "", "l1", "l2", "signs"])
    assert len({n for n, _ in want}) == len(want)
    assert {"12", "empty", "q=1?%:é"} <= {n for n, _ in want}
    path = work_path(spark, "named")
    st.write_named_texts(df, "name", "text", path)
    assert {(r["name"], r["value"]) for r in st.read_named_texts(spark, path).collect()} == want

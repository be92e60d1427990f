"""Chunking, stores, changes, graph rounds, order and streams."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import chat, communities as cm, datasets as ds, evaluate as ev, graph as gr, kb, nodes as nd
from tessera.operators.order import dense_ids, running_sum
from tessera.operators.retrieve import ResultCache, document_frequency, postings, updated_index
from tessera.session import bounded_rows, shared_dir, work_path
from tessera.sources import html as hx, readers as rd, stores as st
from tessera.streaming import live

EDGE_TEXTS = ["", "   ", "a", "😀é́ x", "中文 分词 test", "word " * 500, "no breaks at all" * 40]


@pytest.mark.parametrize("size,overlap", [(7, 0), (10, 3), (1, 0)])
def test_windows(spark, size, overlap):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(EDGE_TEXTS)], "doc_id long, text string")
    got = {r[0]: r[1] for r in df.select("doc_id", tx.windows(F.col("text"), size, overlap)).collect()}
    for i, t in enumerate(EDGE_TEXTS):
        assert got[i] == [t[s:s + size] for s in range(0, len(t), size - overlap)]
        if overlap == 0:
            assert "".join(got[i]) == t
    words = {r[0]: r[1] for r in df.select("doc_id", tx.windows(F.col("text"), size, overlap, "word")).collect()}
    for i, t in enumerate(EDGE_TEXTS):
        w = t.lower().split()
        assert words[i] == [" ".join(w[s:s + size]) for s in range(0, len(w), size - overlap)]
    with pytest.raises(ValueError):
        tx.windows(F.col("text"), 3, 3)


def test_chinese_words(spark):
    df = spark.createDataFrame([("我爱Spark 引擎",), ("",), ("plain Text",)], "t string")
    got = [r[0] for r in df.select(tx.cjk_words(F.col("t"))).collect()]
    assert got == [["我", "爱", "我爱", "spark", "引", "擎", "引擎"], [], ["plain", "text"]]


def test_sections_and_boxes(spark):
    blocks = [(True, "T1"), (False, "a" * 3000), (False, "b" * 1100), (False, "c"), (True, "T2"), (True, "T3"), (False, "d" * 5000)]
    df = spark.createDataFrame([(blocks,), ([],)], "b array<struct<title:boolean,content:string>>")
    got = [r[0] for r in df.select(nd.section_starts(F.col("b"))).collect()]
    groups, current = [], []
    for i, (title, text) in enumerate(blocks):
        joined = "\n\n".join(blocks[j][1] for j in current) + ("\n\n" if current else "") + text
        if title or not current or len(joined) >= 4096:
            groups.append(i)
            current = [i]
        else:
            current.append(i)
    assert got == [groups, []]
    boxes = spark.createDataFrame([([(10, 0, 100, 20), (5, 30, 150, 50), (20, 60, 90, 70)],)],
                                  "b array<struct<left:int,top:int,right:int,bottom:int>>")
    assert tuple(boxes.select(nd.box_union(F.col("b"))).first()[0]) == (20, 0, 150, 70)


def test_semantic_chunks(spark):
    df = spark.createDataFrame([(["a b c", "a b d", "x y", "x y z", "q"],)], "s array<string>")
    assert df.select(nd.semantic_chunks(F.col("s"), 0.5)).first()[0] == ["a b c a b d", "x y x y z", "q"]


def test_visible_text_and_fields(spark):
    page = ("<html><head><title>Tea &amp; co</title><style>p{}</style><script>x='</p>'</script></head><body><!-- no --><p> one <b>two</b></p>"
            "<div class='authors'>By <a href='#'>Ann</a>, <a href='#'>Bo</a></div><h1 class='title big'>Title:X</h1><br>end</body></html>")
    df = spark.createDataFrame([(page,), ("",), (None,), ("<p>open",)], "html string")
    got = [r[0] for r in df.select(hx.visible_text("html")).collect()]
    assert got[0] == "Tea & co\none\ntwo\nBy\nAnn\n,\nBo\nTitle:X\nend\n" and got[1:3] == ["", ""] and got[3] == "open\n"
    f = df.select(hx.class_fields(F.col("html"), {"title": "title big", "author": "authors"}, ("author",)).alias("f")).first()["f"]
    assert f.asDict() == {"title": "Title:X", "author": "Ann;Bo"}


def test_reader_rules(spark):
    files = spark.createDataFrame([("a/x.html", "<p>A</p>"), ("a/y.yml", "k: v"), ("b_z.txt", "t")], "doc_path string, content string")
    rules = (rd.ReaderRules().add("*.html", "global", F.upper).add("*.yml", "global", lambda c: F.lit("G"))
             .add("*.yml", "local", lambda c: F.lit("L"), kb="one").add("b_?.txt", "pattern", lambda c: c))
    one = [(r["reader"], r["text"]) for r in rules.read(files, "one").collect()]
    two = [(r["reader"], r["text"]) for r in rules.read(files, "two").collect()]
    assert one == [("global", "<P>A</P>"), ("local", "L"), ("pattern", "t")] and two[1] == ("global", "G")


def test_text_files_round_trip(spark):
    path = work_path(spark, "named")
    df = spark.createDataFrame([("a/b", " one "), ("c", "two\nlines")], "name string, text string")
    st.write_named_texts(df, "name", "text", path)
    got = {r["doc_path"].split("name=")[1].split("/")[0]: r["text"] for r in rd.scan_texts(spark, path, "*.txt").collect()}
    assert got == {"a_b": "one\n", "c": "two\nlines\n"}
    assert rd.scan_files(spark, path, "*.txt").count() == 2


def test_json_array(spark):
    path = work_path(spark, "json")
    spark.createDataFrame([('[{"a": 1, "b": "x"}, {"a": 2, "b": "y\\nz"}]',)], "value string").coalesce(1).write.text(path)
    assert sorted(tuple(r) for r in rd.scan_json(spark, path, "a long, b string", True).collect()) == [(1, "x"), (2, "y\nz")]


def test_kb_files(spark):
    texts = [f"text {i % 25}" for i in range(60)]
    rows = st.kb_files(spark.createDataFrame([(t,) for t in texts], "text string")).orderBy("file_no").collect()
    assert [r["n"] for r in rows] == [10, 10, 5]
    assert sorted(x for r in rows for x in r["content"].split("\n")) == sorted(set(texts))


def test_vector_collection_rejects_other_dimension(spark):
    store = st.VectorCollection(spark, "v", 2, "kind")
    store.insert(spark.createDataFrame([(1, [1.0, 2.0], "a")], "id long, vec array<double>, kind string"))
    with pytest.raises(Exception, match="dimension"):
        store.insert(spark.createDataFrame([(2, [1.0], "a")], "id long, vec array<double>, kind string"))
    assert store.search_space("kind = 'a'", ["id"]).collect()[0][0] == 1


def test_running_sum_and_ids_with_a_hot_key(spark):
    rnd = random.Random(1)
    rows = [("hot" if rnd.random() < 0.4 else f"k{rnd.randrange(20)}", i, rnd.randrange(9)) for i in range(800)]
    got = running_sum(spark.createDataFrame(rows, "k string, pos long, v long"), "k", "pos", "v", "s", block=16).collect()
    total, want = {}, {}
    for k, i, v in rows:
        total[k] = total.get(k, 0) + v
        want[i] = total[k]
    assert {r["pos"]: r["s"] for r in got} == want
    hashed = spark.range(500).withColumn("h", F.sha2(F.col("id").cast("string"), 256))
    ids = dense_ids(hashed, "h", "n").orderBy("h").collect()
    assert [r["n"] for r in ids] == list(range(500))


def test_negatives_and_split(spark):
    df = spark.range(40).select(F.col("id"), F.concat(F.lit("t"), "id").alias("t"))
    rows = ds.negatives(df, 5, 7, "id", "t").collect()
    assert len(rows) == 200 and all(r["id"] != r["neg_key"] and r["negative"] == f"t{r['neg_key']}" for r in rows)
    again = ds.negatives(df.repartition(7), 5, 7, "id", "t").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    part = spark.range(5000).select(ds.split_mark(F.col("id"), 3).alias("p")).groupBy("p").count().collect()
    assert 350 < {r["p"]: r["count"] for r in part}["test"] < 650


def test_messages_back(spark):
    df = spark.createDataFrame([(1, [("user", "<image>q"), ("assistant", "a")], ["i.png"]), (2, [("user", "q")], [])],
                               "id long, messages array<struct<role:string,content:string>>, images array<string>")
    assert [tuple(r) for r in ds.from_messages(df, ("id",)).collect()] == [(1, "q", "a", "i.png"), (2, "", "", "")]


def test_same_length_fails_on_a_missing_row(spark):
    a, b = spark.range(3), spark.range(4)
    assert ev.same_length(a, spark.range(3).withColumn("x", F.lit(1)), "id").count() == 3
    with pytest.raises(Exception, match="no partner for 3"):
        ev.same_length(a, b.withColumn("x", F.lit(1)), "id").collect()


def test_session_pieces(spark):
    turns = [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(10)] + [(2, 0, "user", "only")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    pieces = chat.history_text(df, block=4).orderBy("conv_id", "piece").collect()
    whole = "\n".join(r["history"] for r in pieces if r["conv_id"] == 1)
    assert whole == "\n".join(f"{r}: {t}" for c, _, r, t in turns if c == 1) and len(pieces) == 4


def test_kb_upload_twice_in_one_batch(spark):
    schema = "kb string, path string, doc_id long, version int, text string"
    base = spark.createDataFrame([("k", "a", 1, 0, "old"), ("k", "b", 2, 0, "b")], schema)
    batch = spark.createDataFrame([("k", "a", 1, 1, "mid"), ("k", "a", 1, 2, "new"), ("k", "c", 3, 1, "c")], schema)
    assert sorted((r["path"], r["text"]) for r in kb.uploaded(base, batch).collect()) == [("a", "new"), ("b", "b"), ("c", "c")]
    assert sorted((r["path"], r["text"]) for r in kb.uploaded(base, batch, False).collect()) == [("a", "old"), ("b", "b"), ("c", "c")]


def test_index_delta_equals_rebuild(spark):
    docs = [(i, f"w{i % 3} w{i % 5} common") for i in range(30)]
    words = lambda rows: spark.createDataFrame(rows, "id long, t string").select("id", tx.words(F.col("t")).alias("words"))
    old = postings(words(docs[:20]), ["id"])
    index, df = updated_index(old, document_frequency(old), postings(words(docs[20:]), ["id"]),
                              spark.createDataFrame([(3,), (4,)], "id long"), ["id"])
    kept = postings(words([d for d in docs if d[0] not in (3, 4)]), ["id"])
    assert sorted(map(tuple, index.select("id", "term", "tf").collect())) == sorted(map(tuple, kept.select("id", "term", "tf").collect()))
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, document_frequency(kept).collect()))


def test_result_cache(spark):
    calls = []

    def search(q):
        calls.append(q.count())
        return q.select("qid", F.length("text").alias("score"))

    cache = ResultCache(spark)
    q = spark.createDataFrame([(1, "abc"), (2, "abc "), (3, "zz")], "qid long, text string")
    first = sorted((r["qid"], r["score"]) for r in cache.answer(q, "v1", search).collect())
    again = sorted((r["qid"], r["score"]) for r in cache.answer(q, "v1", search).collect())
    assert first == again and len(first) == 3 and calls == [2, 0]
    cache.answer(q, "v2", search).collect()
    assert calls == [2, 0, 2]


def chain_edges():
    edges = [(i, i + 1) for i in range(0, 60)]
    edges += [(100, i) for i in range(101, 140)] + [(300, 301), (301, 302), (302, 300), (400, 400)]
    return edges


def test_components_match_union_find(spark):
    edges = chain_edges()
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    got = cm.connected_components(spark.createDataFrame(edges, "src long, tgt long")).collect()
    assert {r["node"]: r["component"] for r in got} == {n: find(n) for n in parent}


def test_reach(spark):
    edges = spark.createDataFrame([("a", "b"), ("c", "b"), ("c", "d"), ("x", "y")], "src string, tgt string")
    start = spark.createDataFrame([("a",)], "node string")
    assert {r["node"]: r["hop"] for r in gr.reached(edges, start, 2).collect()} == {"a": 0, "b": 1, "c": 2}


def test_live_index_replays_and_replaces(spark):
    docs = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    index = live.LiveIndex(spark, lambda d: nd.explode_nodes(d, tx.pieces(F.col("text"), "\n")))
    index.take(docs([(1, "a\nb"), (2, "c")]), 0)
    index.take(docs([(1, "z")]), 1)
    index.take(docs([(1, "z")]), 1)
    assert sorted((r["doc_id"], r["pos"], r["content"]) for r in index.nodes().collect()) == [(1, 0, "z"), (2, 0, "c")]


def test_session_state_over_batches(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    src = work_path(spark, "src")
    for part in ([(1, 0, "aa"), (2, 0, "b")], [(1, 2, "d"), (1, 1, "ccc")]):
        spark.createDataFrame(part, "conv_id long, turn long, text string").coalesce(1).write.mode("append").parquet(src)
    out, cp = work_path(spark, "out"), work_path(spark, "cp")
    stream = live.session_stream(live.file_stream(spark, src, "*.parquet"))
    stream.writeStream.format("parquet").option("checkpointLocation", cp).trigger(availableNow=True).start(out).awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("conv_id", "turn", "turns_before", "chars_before").collect())
    assert got == [(1, 0, 0, 0), (1, 1, 1, 2), (1, 2, 2, 5), (2, 0, 0, 0)]


def test_bounded_rows_and_shared_dir(spark):
    assert bounded_rows(spark.range(5), 4) is None and bounded_rows(spark.range(5), 5).num_rows == 5
    assert shared_dir(spark) == shared_dir(spark)


def test_word_counts(spark):
    from collections import Counter

    rows = [(["b", "a", "b", "b", "c"],), ([],), (["x"],), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "w array<string>").select(tx.word_counts(F.col("w"))).collect()]
    for (words,), counts in zip(rows[:3], got):
        assert {c["term"]: c["tf"] for c in counts} == Counter(words)
    assert not got[3]

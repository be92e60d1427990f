"""Vectors (V rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as tx, vector as vx
from tessera.operators import vectors as vc
from tessera.operators.coded_cells import CodedCells
from tessera.operators.search import block_search, vector_scorer
from tessera.plans.common import MEANS, WORDS, label_means, lines, ranked, vector_nodes
from tessera.plans.registry import query
from tessera.session import cut


@query("v1_embed")
def v1_embed(t):
    """Two keys per line: hashed words in 32 and in 64 buckets."""
    models = {"small": lambda n: vc.hashed_vectors(n, "content", 32), "large": lambda n: vc.hashed_vectors(n, "content", 64)}
    return vc.embed(lines(t), "content", models).select("doc_id", "pos", "embed_key", "vec")


@query("v2_sparse", f"""WITH tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({WORDS.format('text')}) AS term FROM documents) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
SELECT doc_id, term, tf, round(tf * ln((SELECT count(*) FROM documents) / df::DOUBLE), 6) AS w FROM tf JOIN df USING (term)""")
def v2_sparse(t):
    nodes = t.documents.select("doc_id", tx.words(F.col("text")).alias("words"))
    return vc.sparse_vectors(nodes, ["doc_id"]).withColumn("w", F.round("w", 6))


@query("v3_mean_word_vector", f"""WITH w AS (SELECT doc_id, unnest({WORDS.format('text')}) AS term FROM documents),
x AS (SELECT doc_id, length(term) % (SELECT count(*) FROM embeddings) AS vec_id, count(*) AS n FROM w GROUP BY ALL),
m AS (SELECT doc_id, dim, sum(v * n) / sum(n) AS v FROM (SELECT doc_id, n, unnest(range(0, 64)) AS dim, unnest(embedding)::DOUBLE AS v FROM x JOIN embeddings USING (vec_id)) GROUP BY ALL)
SELECT doc_id, round(max(v) FILTER (dim = 0), 6) + 0.0 AS first, round(max(v) FILTER (dim = 63), 6) + 0.0 AS last, round(sqrt(sum(v * v)), 6) AS norm FROM m GROUP BY doc_id""")
def v3_mean_word_vector(t):
    """A word's vector is picked by its length; equal picks of a document are counted before the join."""
    size = t.embeddings.agg(F.count("*")).scalar()
    words = t.documents.select("doc_id", F.explode(tx.words(F.col("text"))).alias("term"))
    picks = words.groupBy("doc_id", (F.length("term") % size).alias("vec_id")).agg(F.count("*").alias("n"))
    mean = vc.mean_vectors(picks.join(vector_nodes(t), "vec_id").select("doc_id", "n", "vec"), ["doc_id"], "vec", "n")
    return mean.select("doc_id", F.round(F.col("vec")[0], 6).alias("first"), F.round(F.col("vec")[63], 6).alias("last"),
                       F.round(vx.norm(F.col("vec")), 6).alias("norm"))


@query("v4_blend", f"""WITH {MEANS}, b AS (SELECT vec_id, list_transform(range(1, 65), lambda i: embedding[i]::DOUBLE * 0.4 + vec[i] * 0.6) AS v
  FROM embeddings JOIN mv USING (label))
SELECT vec_id, round(v[1], 6) + 0.0 AS first, round(v[64], 6) + 0.0 AS last, round(sqrt(list_inner_product(v, v)), 6) AS norm FROM b""")
def v4_blend(t):
    pairs = vector_nodes(t).join(label_means(t).withColumnRenamed("vec", "mean"), "label")
    mixed = pairs.select("vec_id", vx.blend(F.col("vec"), F.col("mean"), 0.4, 0.6).alias("v"))
    return mixed.select("vec_id", F.round(F.col("v")[0], 6).alias("first"), F.round(F.col("v")[63], 6).alias("last"),
                        F.round(vx.norm(F.col("v")), 6).alias("norm"))


@query("v5_incremental", """SELECT sha256(text) AS hash, length(any_value(text)) AS chars FROM documents
WHERE text NOT IN (SELECT text FROM documents WHERE lang = 'en') GROUP BY 1""")
def v5_incremental(t):
    """English texts have vectors already; what is left is embedded."""
    stored = t.documents.filter("lang = 'en'").select(F.sha2("text", 256).alias("hash")).distinct()
    return vc.missing_vectors(t.documents, stored, "text").select("hash", F.length("content").cast("bigint").alias("chars"))


@query("v6_product_quantisation")
def v6_product_quantisation(t):
    nodes = vector_nodes(t)
    books = vc.train_codebooks(nodes, 8, 16)
    coded = vc.encode_codes(nodes, books, ["vec_id"])
    queries = label_means(t).withColumnRenamed("label", "qid")
    return vc.code_search(coded, nodes, queries, books, 10, ["vec_id"], survivors=100)


def _coded(t):
    """12 cells, six parts of 64 dimensions (widths 10 and 11), 64 codes each."""
    index = CodedCells(t.spark, ["vec_id"], cells=12, parts=6, codes=64)
    index.write(vector_nodes(t).select("vec_id", "vec"))
    return index


@query("v6_coded_rows", "SELECT vec_id, 6 AS code_bytes FROM embeddings WHERE list_inner_product(embedding, embedding) > 0")
def v6_coded_rows(t):
    """Every vector is stored once, in six bytes."""
    return _coded(t).rows().select("vec_id", F.octet_length("code").alias("code_bytes"))


@query("v6_coded_cells", "SELECT DISTINCT label AS qid, 10 AS n, true AS recall_reached FROM embeddings WHERE label IS NOT NULL")
def v6_coded_cells(t):
    """Six of twelve cells, 200 survivors by code, against the exact top 10: whether the mean recall over all queries reaches 0.8."""
    queries = label_means(t).withColumnRenamed("label", "qid")
    found = cut(_coded(t).search(queries, 10, nprobe=6, survivors=200).select("qid", "vec_id", F.lit(1).alias("hit")))
    exact = block_search(vector_nodes(t), queries, vector_scorer("cosine"), 10, ["vec_id"], ["vec"]).select("qid", "vec_id")
    recall = exact.join(found, ["qid", "vec_id"], "left").agg(F.avg(F.coalesce("hit", F.lit(0)))).scalar()
    per_query = found.groupBy("qid").agg(F.count("*").cast("int").alias("n"))
    return per_query.withColumn("recall_reached", F.coalesce(recall, F.lit(0.0)) >= 0.8)


@query("v7_inverted_file", f"""WITH {MEANS}, sc AS (SELECT mv.label AS qid, vec_id, round(list_cosine_similarity(vec, embedding::DOUBLE[]), 6) AS score FROM mv, embeddings)
{ranked('sc', 10)}""")
def v7_inverted_file(t):
    """All cells probed: equals the exact search."""
    nodes = vector_nodes(t)
    model = vc.train_cells(nodes, 8)
    queries = label_means(t).withColumnRenamed("label", "qid")
    return vc.cell_search(vc.write_cells(nodes, model, ["vec_id"]), model, queries, 10, ["vec_id"], nprobe=8)

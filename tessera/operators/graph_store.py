"""A merged graph kept up to date under additions and removals of chunks.

Stored are the evidence (a row per link and chunk), the merged relations and every node's component. A change touches the keys of the
links that come or go: only these are merged again, from their evidence. Components follow from the old ones: where a relation
vanished, the components of its ends are worked out again from their own relations; then relations that appeared join components by
their roots, a graph with a node per root concerned. A version is complete when its ``roots`` are written; one that failed before is
written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.operators.communities import connected_components
from tessera.session import cut, exists, work_path

KEY = ["src", "tgt"]
EVIDENCE = "src string, tgt string, doc_id bigint, pos int, version int"


class StoredGraph:
    """Versions of a graph below ``path``; ``evidence`` given to it has src, tgt, doc_id and pos."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or work_path(spark, "graph")
        self.version = -1
        while exists(spark, f"{self.path}/roots/version={self.version + 1}/_SUCCESS"):
            self.version += 1

    def _read(self, name: str, schema: str) -> DataFrame:
        where = f"{self.path}/{name}/version={self.version}"
        return self.spark.read.schema(schema).parquet(where) if self.version >= 0 else self.spark.createDataFrame([], schema)

    def relations(self) -> DataFrame:
        """src, tgt, weight (links) and n_chunks of every relation."""
        return self._read("relations", "src string, tgt string, weight bigint, n_chunks bigint")

    def roots(self) -> DataFrame:
        """node, component: the smallest node it is linked with over any number of steps."""
        return self._read("roots", "node string, component string")

    def evidence(self) -> DataFrame:
        """Links of all chunks that were added and not removed by a later version, or by their own."""
        if not exists(self.spark, f"{self.path}/evidence"):
            return self.spark.createDataFrame([], EVIDENCE)
        rows = self.spark.read.schema(EVIDENCE).parquet(f"{self.path}/evidence").filter(F.col("version") <= self.version)
        gone = self.spark.read.schema("doc_id bigint, version int").parquet(f"{self.path}/gone").filter(F.col("version") <= self.version)
        last = gone.groupBy(F.col("doc_id").alias("_doc")).agg(F.max("version").alias("_gone"))
        return rows.join(last, (F.col("doc_id") == F.col("_doc")) & (F.col("version") < F.col("_gone")), "left_anti")

    def apply(self, added: DataFrame, removed: DataFrame | None = None) -> None:
        """A new version: all chunks of the ``removed`` doc_id go, then the ``added`` evidence comes."""
        new = self.version + 1
        old_relations, old_roots, before = self.relations(), self.roots(), self.evidence()
        ids = (removed if removed is not None else added.limit(0)).select(F.col("doc_id").cast("bigint").alias("doc_id")).filter("doc_id is not null").distinct()
        ids.write.mode("overwrite").parquet(f"{self.path}/gone/version={new}")
        ids = self.spark.read.schema("doc_id bigint").parquet(f"{self.path}/gone/version={new}")
        fresh = added.filter("src is not null and tgt is not null").select(*KEY, F.col("doc_id").cast("bigint"), F.col("pos").cast("int"))
        fresh.write.mode("overwrite").parquet(f"{self.path}/evidence/version={new}")
        fresh = self.spark.read.schema("src string, tgt string, doc_id bigint, pos int").parquet(f"{self.path}/evidence/version={new}")
        gone = before.join(ids, "doc_id", "left_semi")
        touched = cut(fresh.select(*KEY).unionByName(gone.select(*KEY)).distinct())
        left = before.select(*KEY, "doc_id", "pos").join(touched, KEY, "left_semi").join(ids, "doc_id", "left_anti")
        merged = cut(left.unionByName(fresh).groupBy(*KEY, "doc_id", "pos").agg(F.count("*").alias("n"))
                     .groupBy(*KEY).agg(F.sum("n").alias("weight"), F.count("*").alias("n_chunks")))
        kept = old_relations.join(touched, KEY, "left_anti")
        kept.unionByName(merged).write.mode("overwrite").parquet(f"{self.path}/relations/version={new}")
        was = old_relations.join(touched, KEY, "left_semi").select(*KEY)
        vanished, appeared = was.join(merged, KEY, "left_anti"), merged.select(*KEY).join(was, KEY, "left_anti")
        stayed = kept.select(*KEY).unionByName(merged.select(*KEY).join(was, KEY, "left_semi"))
        roots = self._joined(self._repaired(old_roots, stayed, vanished), appeared)
        roots.write.mode("overwrite").parquet(f"{self.path}/roots/version={new}")
        self.version = new

    def _repaired(self, roots: DataFrame, stayed: DataFrame, vanished: DataFrame) -> DataFrame:
        """Roots after relations vanished: their components are worked out again, all others stay."""
        ends = vanished.select(F.explode(F.array(*KEY)).alias("node")).distinct()
        broken = cut(roots.join(ends, "node", "left_semi").select("component").distinct())
        if broken.isEmpty():
            return roots
        nodes = roots.join(broken, "component", "left_semi")
        inside = stayed.join(nodes.select(F.col("node").alias("src")), "src", "left_semi").select(*KEY)
        return cut(roots.join(broken, "component", "left_anti").select("node", "component").unionByName(connected_components(cut(inside))))

    def _joined(self, roots: DataFrame, appeared: DataFrame) -> DataFrame:
        """Roots after relations appeared: components they connect get one root; new nodes bring their own."""
        at = lambda c: roots.select(F.col("node").alias(c), F.col("component").alias(f"{c}_root"))
        ends = cut(appeared.join(at("src"), "src", "left").join(at("tgt"), "tgt", "left")
                   .select(*KEY, F.coalesce("src_root", "src").alias("a"), F.coalesce("tgt_root", "tgt").alias("b")))
        if ends.isEmpty():
            return roots
        united = cut(connected_components(ends.select(F.col("a").alias("src"), F.col("b").alias("tgt")).distinct()).withColumnRenamed("component", "top"))
        fresh = ends.select(F.explode(F.array(*KEY)).alias("node")).distinct().join(roots, "node", "left_anti").select("node", F.col("node").alias("component"))
        every = roots.select("node", "component").unionByName(fresh)
        return every.join(united.withColumnRenamed("node", "component"), "component", "left").select("node", F.coalesce("top", "component").alias("component"))

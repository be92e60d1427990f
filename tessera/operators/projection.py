"""Approximate vector search by stored buckets of random projections.

Unit vectors are projected on random directions and cut into buckets of a fixed length; some directions together are a table. A node is stored
once per table. A query looks in its bucket of every table and in those next to it, so near nodes just over an edge are found too; what it
finds is scored exactly. A shorter bucket and more directions per table read less and find less.
"""

from __future__ import annotations

from itertools import product

from pyspark.ml.feature import BucketedRandomProjectionLSH, BucketedRandomProjectionLSHModel, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.functions.vector import cosine
from tessera.operators.search import top_k
from tessera.session import work_path


class ProjectionIndex:
    """Buckets and vectors below ``path``; ``directions`` to each of ``tables``."""

    def __init__(self, spark: SparkSession, keys: list[str], tables: int = 8, directions: int = 2, length: float = 0.25, seed: int = 5, path: str | None = None):
        self.spark, self.keys, self.path = spark, keys, path or work_path(spark, "projections")
        self.tables, self.directions = tables, directions
        self.lsh = BucketedRandomProjectionLSH(inputCol="_unit", outputCol="_h", bucketLength=length, numHashTables=tables * directions, seed=seed)
        self.model: BucketedRandomProjectionLSHModel | None = None

    @staticmethod
    def _unit(rows: DataFrame, vec: str) -> DataFrame:
        """Rows with a unit vector; null and zero vectors are left out."""
        sound = rows.filter(F.col(vec).isNotNull() & F.exists(vec, lambda v: v != 0) & ~F.exists(vec, lambda v: v.isNull() | F.isnan(v)))
        return Normalizer(inputCol="_v", outputCol="_unit").transform(sound.withColumn("_v", array_to_vector(F.col(vec).cast("array<double>")))).drop("_v")

    def _placed(self, hashed: DataFrame, keep: list[str]) -> DataFrame:
        """``keep``, table and the bucket number of each of its directions, a row per table."""
        at = lambda i: vector_to_array(F.col("_h")[i])[0].cast("bigint")
        tables = [F.array(*[at(t * self.directions + d) for d in range(self.directions)]) for t in range(self.tables)]
        return hashed.select(*keep, F.posexplode(F.array(*tables)).alias("table", "place"))

    def write(self, nodes: DataFrame, vec: str = "vec") -> None:
        """Store the nodes in their buckets; all vectors must have one length."""
        unit = self._unit(nodes.select(*self.keys, vec), vec)
        self.model = self.lsh.fit(unit)
        placed = self._placed(self.model.transform(unit), self.keys)
        placed.select(*self.keys, F.xxhash64("table", "place").alias("bucket")).write.parquet(f"{self.path}/buckets")
        nodes.select(*self.keys, F.col(vec).alias("vec")).write.parquet(f"{self.path}/vectors")

    def search(self, queries: DataFrame, k: int, vec: str = "vec", qid: str = "qid") -> DataFrame:
        """qid, keys, score (cosine, six digits), rk of the best k found; ties by key."""
        hashed = self.model.transform(self._unit(queries.select(qid, vec), vec))
        steps = F.array(*[F.array(*[F.lit(s).cast("bigint") for s in step]) for step in product((0, -1, 1), repeat=self.directions)])
        around = self._placed(hashed, [qid]).select(qid, "table", "place", F.explode(steps).alias("step"))
        asked = around.select(qid, F.xxhash64("table", F.zip_with("place", "step", lambda p, s: p + s)).alias("bucket"))
        met = asked.join(self.spark.read.parquet(f"{self.path}/buckets"), "bucket").select(qid, *self.keys).distinct()
        pairs = met.join(self.spark.read.parquet(f"{self.path}/vectors"), self.keys).join(queries.select(qid, F.col(vec).alias("_q")), qid)
        return top_k(pairs.select(qid, *self.keys, F.round(cosine(F.col("_q"), F.col("vec")), 6).alias("score")), [qid], k, self.keys)

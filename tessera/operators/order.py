"""Global numbering and running sums without a one-task sort of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def dense_ids(df: DataFrame, hash_col: str, out: str) -> DataFrame:
    """0..N-1 in order of a unique hex hash.

    The first four hex digits are even buckets. Only the 65,536 bucket counts are summed in
    one place; rows are numbered inside their bucket.
    """
    bucketed = df.withColumn("_b", F.substring(hash_col, 1, 4))
    counts = bucketed.groupBy("_b").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select("_b", F.coalesce(before, F.lit(0)).alias("_start"))
    ranked = bucketed.withColumn("_r", F.row_number().over(W.partitionBy("_b").orderBy(hash_col)) - 1)
    return ranked.join(offsets, "_b").withColumn(out, F.col("_start") + F.col("_r")).drop("_b", "_start", "_r")


def running_sum(df: DataFrame, key: str, pos: str, value: str, out: str, block: int = 4096) -> DataFrame:
    """Sum of ``value`` up to each row, per key in order of an integer position.

    Works in blocks of positions, so a key with a third of all rows is many small groups; only
    one row per block meets its neighbours.
    """
    blocked = df.withColumn("_blk", F.floor(F.col(pos) / block))
    sums = blocked.groupBy(key, "_blk").agg(F.sum(value).alias("_s"))
    before = F.sum("_s").over(W.partitionBy(key).orderBy("_blk").rowsBetween(W.unboundedPreceding, -1))
    offsets = sums.select(key, "_blk", F.coalesce(before, F.lit(0)).alias("_start"))
    inside = F.sum(value).over(W.partitionBy(key, "_blk").orderBy(pos).rowsBetween(W.unboundedPreceding, 0))
    offsets = offsets.withColumnsRenamed({key: "_key", "_blk": "_of"})
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("_blk").eqNullSafe(F.col("_of"))  # null keys and positions are groups too
    return (blocked.withColumn("_in", inside).join(offsets, same)
            .withColumn(out, F.col("_start") + F.col("_in")).drop("_blk", "_in", "_start", "_key", "_of"))

"""Retrieval and answer metrics.

Retrieved and reference sets are long tables (one row per query and item), so a query with very
many items is never one cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tessera.functions import text as tx


def context_recall(retrieved: DataFrame, reference: DataFrame, item: str, qid: str = "qid",
                   binary: bool = False) -> DataFrame:
    """``qid, n_ref, n_hit, recall``; queries without a reference do not enter."""
    ref = reference.select(qid, item).distinct()
    got = retrieved.select(qid, item).distinct().withColumn("hit", F.lit(1))
    counts = (ref.join(got, [qid, item], "left").groupBy(qid)
              .agg(F.count("*").alias("n_ref"), F.count("hit").alias("n_hit")))
    share = F.col("n_hit") / F.col("n_ref")
    value = (F.col("n_hit") > 0).cast("double") if binary else share
    return counts.withColumn("recall", F.round(value, 6))


def context_relevance(retrieved: DataFrame, reference: DataFrame, queries: DataFrame, sentence: str, qid: str = "qid") -> DataFrame:
    """Share of the retrieved sentences that occur in the reference; 0 for a query that retrieved none."""
    ref = reference.select(qid, sentence).distinct().withColumn("hit", F.lit(1))
    counts = retrieved.groupBy(qid, sentence).agg(F.count("*").alias("n"))
    joined = counts.join(ref, [qid, sentence], "left").groupBy(qid).agg(
        F.sum("n").alias("n_sentences"), F.coalesce(F.sum(F.when(F.col("hit") == 1, F.col("n"))), F.lit(0)).alias("n_related"))
    share = F.when(F.col("n_sentences") > 0, F.col("n_related") / F.col("n_sentences")).otherwise(0.0)
    every = queries.select(qid).distinct().join(joined, qid, "left").fillna(0, ["n_sentences", "n_related"])
    return every.withColumn("relevance", F.round(share, 6))


def recall_of_flags(df: DataFrame, relevant: Column, returned: Column) -> DataFrame:
    """TP / (TP + FN)."""
    counts = df.agg(F.count_if(relevant & returned).alias("tp"), F.count_if(relevant & ~returned).alias("fn"))
    return counts.withColumn("recall", F.round(F.col("tp") / (F.col("tp") + F.col("fn")), 6))


def reciprocal_ranks(ranked: DataFrame, relevant: DataFrame, queries: DataFrame, item: str, qid: str = "qid") -> DataFrame:
    """``qid, rr``: 1 / rank of the first relevant hit, 0 without one."""
    first = (ranked.join(relevant.select(qid, item).distinct(), [qid, item], "left_semi")
             .groupBy(qid).agg(F.min("rk").alias("rk")))
    return queries.select(qid).join(first, qid, "left").select(
        qid, F.round(F.coalesce(1 / F.col("rk"), F.lit(0.0)), 6).alias("rr"))


def word_support(statement: Column, context: Column) -> Column:
    """Share of a statement's distinct words found among the words of the context."""
    def share(p: Column) -> Column:
        return F.when(F.size(p["s"]) > 0, F.size(F.array_intersect(p["s"], p["c"])) / F.size(p["s"])).otherwise(F.lit(0.0))

    both = F.struct(F.array_distinct(tx.words(statement)).alias("s"), tx.words(context).alias("c"))
    return tx.let(both, share)


def faithfulness(judged: DataFrame, qid: str = "qid", supported: str = "supported") -> DataFrame:
    """Supported statements / statements, from a table of judgements."""
    return judged.groupBy(qid).agg(F.count("*").alias("n"), F.count_if(F.col(supported)).alias("n_supported")).withColumn(
        "faithfulness", F.round(F.col("n_supported") / F.col("n"), 6))


def exact_match(answer: Column, truth: Column) -> Column:
    return (F.trim(answer) == F.trim(truth)).cast("int")


def containment(answer: Column, context: Column) -> Column:
    """1 when every blank-separated word of the answer is a substring of the context."""
    parts = F.filter(F.split(answer, tx.GAP), lambda w: w != "")
    return F.forall(parts, lambda w: F.contains(context, w)).cast("int")


def report(scores: DataFrame, metrics: list[str]) -> DataFrame:
    """Per metric: sum, n and percent with 4 digits."""
    aggregates = [x for m in metrics for x in (F.sum(m).cast("double").alias(f"s_{m}"), F.count(m).alias(f"n_{m}"))]
    row = scores.agg(*aggregates)
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.round(F.col(f"s_{m}"), 6).alias("total"), F.col(f"n_{m}").alias("n"),
                              F.format_string("%.4f%%", 100 * F.col(f"s_{m}") / F.col(f"n_{m}")).alias("percent")) for m in metrics])
    return row.select(F.inline(rows))


BOXED = r"boxed\{((?:[^{}]|\{[^{}]*\})*)\}"


def boxed_values(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(BOXED), 1))


def true_answer(output: Column, mark: str = "\n#### ") -> Column:
    """The part after the last mark, trimmed."""
    return F.trim(F.element_at(F.split(output, f"\\Q{mark}\\E"), -1))


def boxed_correct(text: Column, truth: Column) -> Column:
    """Exactly one distinct boxed value, equal to the truth."""
    return tx.let(boxed_values(text), lambda v: ((F.size(v) == 1) & (F.get(v, F.lit(0)) == truth)))


def sweep(ranked: DataFrame, reference: DataFrame, ks: list[int], item: str, setup: str = "setup", qid: str = "qid") -> DataFrame:
    """Mean recall per set-up at several k, one column per k.

    ``ranked(setup, qid, item, rk)``. One pass: a hit counts from its best rank on.
    """
    ref = reference.select(qid, item).distinct()
    n_ref = ref.groupBy(qid).agg(F.count("*").alias("n_ref"))
    best = ranked.groupBy(setup, qid, item).agg(F.min("rk").alias("rk")).join(ref, [qid, item], "left_semi")
    hits = best.groupBy(setup, qid).agg(*[F.count_if(F.col("rk") <= k).alias(f"k{k}") for k in ks])
    setups = ranked.select(setup).distinct()
    n_queries = n_ref.agg(F.count("*").alias("n")).scalar()
    sums = hits.join(n_ref, qid).groupBy(setup).agg(*[F.sum(F.col(f"k{k}") / F.col("n_ref")).alias(f"s{k}") for k in ks])
    return setups.join(sums, setup, "left").select(
        setup, *[F.round(F.coalesce(F.col(f"s{k}"), F.lit(0.0)) / n_queries, 6).alias(f"recall_at_{k}") for k in ks])


def same_length(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of a full outer join; a row that only one side has fails the job."""
    l, r = left.withColumn("_l", F.lit(True)), right.withColumn("_r", F.lit(True))
    both = l.join(r, key, "full_outer")
    bad = F.col("_l").isNull() | F.col("_r").isNull()
    message = F.concat(F.lit("no partner for "), F.col(key).cast("string"))
    return both.withColumn(key, F.when(bad, F.raise_error(message).cast(left.schema[key].dataType)).otherwise(F.col(key))).drop("_l", "_r")

"""Corpus cleaning: from raw documents to packed token sequences.

Every stage takes (spark, docs, sf_dir), works on all documents its predecessor kept, and returns documents; the last
one returns the pieces and their places in the sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, langid, lines, near, packing
from tessera.llm.queries import TOKENIZER
from tessera.session import cut


def _wrapped(docs: DataFrame) -> DataFrame:
    """doc_id and text; all other columns in one struct, where their names meet no operator's."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    return docs.select("doc_id", "text", rest.alias("rest"))


def _columns(docs: DataFrame, **changed) -> list:
    """The columns of ``docs``, taken out of the struct again."""
    return [F.col("text") if c == "text" else changed.get(c, F.col("rest").getField(c)).alias(c) for c in docs.columns]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language. Those without text or without a single letter go; learned as in ``langid.identify``."""
    profiles = langid.train(docs.where(langid.fold() != 2))
    found = langid.predict(_wrapped(docs), profiles, ["text", "rest"])
    return found.where(F.col("lang_pred") != langid.UNKNOWN).select(_columns(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that earlier ones have; a document that loses all its lines goes. ``n_chars`` follows the text."""
    clean = lines.dedup_lines(_wrapped(docs)).where("n_removed = 0 or n_removed < n_lines")
    changed = {}
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("n_removed") > 0, length).otherwise(F.col("rest").getField("n_chars"))
    return clean.select(_columns(docs, **changed))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: 5-word shingles, Jaccard similarity of 0.8 or more."""
    return near.near_duplicates(_wrapped(docs), n=5, threshold=0.8).where("first").select(_columns(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage, nor a worked-over copy of one."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", pack)]

# Bundles, alignments and token ids have no SQL form; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a table that the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""Readers: file scans and rules that choose a reader by path."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Reader = Callable[[Column], Column]


def scan_texts(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """One row per file: ``doc_path, text``."""
    files = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
             .text(path, wholetext=True))
    return files.select(F.col("_metadata.file_path").alias("doc_path"), F.col("value").alias("text"))


def scan_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """One row per file: ``doc_path, content`` (binary), ``length``, ``modified``."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", glob).load(path))
    return files.select(F.col("path").alias("doc_path"), "content", "length",
                        F.col("modificationTime").alias("modified"))


def scan_json(spark: SparkSession, path: str, schema: str, whole_array: bool = False) -> DataFrame:
    """JSON lines, or files that each hold one JSON array."""
    return spark.read.schema(schema).option("multiLine", whole_array).json(path)


def scan_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def scan_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The rows of the Parquet table ``name`` in ``folder``, one file or a folder of files, with the ``file`` of the folder they come from."""
    entry = F.regexp_extract("_metadata.file_path", rf"^.*/(\Q{name}\E)(?:/|$)", 1)
    return spark.read.parquet(f"{folder}/{name}").select("*", entry.alias("file"))


@dataclass(frozen=True)
class _Rule:
    glob: str
    name: str
    reader: Reader
    kb: str | None


class ReaderRules:
    """Readers by path pattern. Rules of a knowledge base beat global ones; then the first added."""

    def __init__(self):
        self._rules: list[_Rule] = []

    def add(self, glob: str, name: str, reader: Reader, kb: str | None = None) -> ReaderRules:
        self._rules.append(_Rule(glob, name, reader, kb))
        return self

    def read(self, files: DataFrame, kb: str, path: str = "doc_path", content: str = "content") -> DataFrame:
        """Adds ``reader`` and ``text``; both null where no rule fits."""
        rules = [r for r in self._rules if r.kb == kb] + [r for r in self._rules if r.kb is None]
        name, text = F.lit(None).cast("string"), F.lit(None).cast("string")
        for rule in reversed(rules):
            fits = F.col(path).like(_like(rule.glob))
            name = F.when(fits, F.lit(rule.name)).otherwise(name)
            text = F.when(fits, rule.reader(F.col(content))).otherwise(text)
        return files.withColumn("reader", name).withColumn("text", text)


def _like(glob: str) -> str:
    for special in ("\\", "%", "_"):
        glob = glob.replace(special, "\\" + special)
    return glob.replace("*", "%").replace("?", "_")

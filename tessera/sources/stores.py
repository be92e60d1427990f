"""Sinks and stores: tables, files, vector collections, snapshots."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tessera.operators.order import dense_ids
from tessera.session import exists, spread, work_path
from tessera.sources.collection import _place


def load_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Create the table if it is absent and append the rows."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        place = path or work_path(spark, name)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{place}'")
    df.write.insertInto(name)
    return spark.table(name)


def load_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    df.write.jdbc(url, table, mode="append", properties=properties)


def safe_name(name: Column) -> Column:
    return F.regexp_replace(name, r"[/\\]", "_")


NAME_CHARS = 100  # longer names are cut


def named_texts(df: DataFrame, name: str, text: str) -> DataFrame:
    """``name, value``: a safe file name and its trimmed text, a row per file.

    Where several would get one name (``a/b`` and ``a_b``, or one name with two texts), all of these end in sixteen digits of the hash of
    name and text. Equal rows are one file, a null text is an empty one; rows with a null or empty name are left out.
    """
    rows = df.select(F.col(name).alias("_name"), F.trim(F.coalesce(text, F.lit(""))).alias("value")).filter("_name <> ''").distinct()
    safe = rows.withColumn("name", F.substring(safe_name(F.col("_name")), 1, NAME_CHARS))
    several = safe.groupBy("name").count().filter("count > 1").select("name", F.lit(True).alias("_several"))
    digits = F.substring(F.sha2(F.concat("_name", F.lit("\n"), "value"), 256), 1, 16)
    whole = F.when(F.col("_several"), F.concat("name", F.lit("-"), digits)).otherwise(F.col("name"))
    return safe.join(several, "name", "left").select(whole.alias("name"), "value")


FILE_LIST = "_files"  # Spark's readers pass over names that begin so
READ_BYTES = 16 << 20  # of texts held before they are handed on
SPECIAL = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")  # what Spark escapes in the folders of a partition


def _folder(name: str) -> str:
    return "name=" + SPECIAL.sub(lambda m: f"%{ord(m[0]):02X}", name)


def write_named_texts(df: DataFrame, name: str, text: str, path: str) -> None:
    """One text file per name (see ``named_texts``), below ``name=<safe name>``; a newline ends it.

    Tasks write the files in place, so nothing is moved or listed by the driver. A file is called by the hash of its text: an attempt that
    is repeated writes the same files, and each appears whole. The list of names and files, a table, is done last and marks the whole as written.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _place(path)
        for batch in batches:
            names, written = batch.column("name").to_pylist(), []
            for at, value in zip(names, batch.column("value").to_pylist()):
                file = f"{_folder(at)}/part-{hashlib.sha256(value).hexdigest()[:32]}.txt"
                aside = f"{root}/{_folder(at)}/.{uuid.uuid4().hex}.part"
                files.create_dir(f"{root}/{_folder(at)}", recursive=True)
                with files.open_output_stream(aside) as f:
                    f.write(value + b"\n")
                files.move(aside, f"{root}/{file}")
                written.append(file)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(written, pa.string())], ["name", "file"])

    rows = named_texts(df, name, text).select("name", F.col("value").cast("binary").alias("value"))
    rows.mapInArrow(task, "name string, file string").write.parquet(f"{path}/{FILE_LIST}")


def read_named_texts(spark: SparkSession, path: str) -> DataFrame:
    """``name, value`` of what ``write_named_texts`` wrote, whole texts without the last newline.

    Every file is read; which there are is a table of its own, so no folder is listed.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _place(path)
        for batch in batches:
            names, values, held = [], [], 0
            for at, file in zip(batch.column("name").to_pylist(), batch.column("file").to_pylist()):
                with files.open_input_stream(f"{root}/{file}") as f:
                    value = f.read()
                names.append(at)
                values.append(value.removesuffix(b"\n"))
                held += len(value)
                if held >= READ_BYTES:
                    yield _texts(names, values)
                    names, values, held = [], [], 0
            yield _texts(names, values)

    listed = spread(spark.read.schema("name string, file string").parquet(f"{path}/{FILE_LIST}"), "name")
    return listed.mapInArrow(task, "name string, value binary").select("name", F.col("value").cast("string").alias("value"))


def _texts(names: list[str], values: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.binary())], ["name", "value"])


def kb_files(contexts: DataFrame, text: str = "text", per_file: int = 10) -> DataFrame:
    """Distinct texts, ``per_file`` to a file, one line each: ``file_no, n, content``.

    Texts are put in order of their hash; the last file may be short.
    """
    distinct = (contexts.select(F.sha2(text, 256).alias("hash"), F.col(text).alias("text"))
                .groupBy("hash").agg(F.first("text").alias("text")))
    placed = dense_ids(distinct, "hash", "id").withColumn("file_no", F.floor(F.col("id") / per_file))
    packed = placed.groupBy("file_no").agg(F.array_sort(F.collect_list(F.struct("id", "text"))).alias("t"))
    return packed.select("file_no", F.size("t").alias("n"), F.array_join("t.text", "\n").alias("content"))


class VectorCollection:
    """Vectors of one dimension in Parquet, partitioned by a scalar field."""

    def __init__(self, spark: SparkSession, name: str, dim: int, field: str, path: str | None = None):
        self.spark, self.dim, self.field = spark, dim, field
        self.path = path or work_path(spark, name)

    def insert(self, df: DataFrame, vec: str = "vec") -> None:
        """Rows of another dimension fail the job."""
        checked = df.withColumn(vec, F.when(F.size(vec) == self.dim, F.col(vec)).otherwise(
            F.raise_error(F.lit(f"vector is not of dimension {self.dim}"))))
        checked.hint("rebalance", F.col(self.field)).write.mode("append").partitionBy(self.field).parquet(self.path)

    def search_space(self, where: str | None = None, output_fields: list[str] | None = None) -> DataFrame:
        rows = self.spark.read.parquet(self.path)
        rows = rows.filter(where) if where else rows
        return rows.select(*output_fields) if output_fields else rows


class Snapshot:
    """Results per content hash; a later start, in this process or another, computes only what is new."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or work_path(spark, "snapshot")
        self.runs = (self.read().agg(F.max("run")).first()[0] or 0) + 1 if exists(spark, self.path) else 0

    def refresh(self, nodes: DataFrame, compute, text: str = "content") -> DataFrame:
        """``hash`` plus what ``compute(content) -> Column`` gives; ``run`` tells when it was made."""
        texts = nodes.select(F.sha2(text, 256).alias("hash"), F.col(text).alias("content"))
        fresh = texts.groupBy("hash").agg(F.first("content").alias("content"))  # copies go map-side
        if self.runs:
            fresh = fresh.join(self.read().select("hash"), "hash", "left_anti")
        (fresh.select("hash", compute(F.col("content")).alias("value"), F.lit(self.runs).alias("run"))
         .write.mode("append").parquet(self.path))
        self.runs += 1
        return self.read()

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

"""Vector collections as a data source: create, drop and insert are atomic, and a filter on the scalar field reads only its files.

A collection is a folder of Parquet files, one scalar value each, and numbered manifests that list them. Whatever changes it writes
its files first and the next manifest last; the highest manifest counts. A failed insert therefore leaves nothing that a reader
could see, and a reader that has begun keeps the files of its manifest until ``vacuum``.

Use ``spark.read.format("tessera_collection").option("path", ...)`` after ``register(spark)``, or ``Collection``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "tessera_collection"
ROWS = 50_000  # of one value held before they are written


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path, of a URI or of a path of the local file system."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if not path.startswith("file:/") or path.startswith("file://") else "file://" + path[5:])
    return fs.LocalFileSystem(), path


def _latest(path: str) -> tuple[int, dict | None]:
    """Number and content of the highest manifest; (-1, None) where there is none."""
    files, root = _place(path)
    found = files.get_file_info(fs.FileSelector(f"{root}/manifests", allow_not_found=True))
    numbers = sorted(int(f.base_name[:-5]) for f in found if f.base_name.endswith(".json"))
    if not numbers:
        return -1, None
    with files.open_input_stream(f"{root}/manifests/{numbers[-1]}.json") as f:
        return numbers[-1], json.loads(f.read())


def _publish(path: str, number: int, manifest: dict) -> None:
    """Make a manifest the latest. It appears whole: written aside, then moved into place."""
    files, root = _place(path)
    files.create_dir(f"{root}/manifests", recursive=True)
    target = f"{root}/manifests/{number}.json"
    if files.get_file_info(target).type != fs.FileType.NotFound:
        raise RuntimeError(f"another change made manifest {number} of {path} first")
    aside = f"{root}/manifests/{number}-{uuid.uuid4().hex}.part"
    with files.open_output_stream(aside) as f:
        f.write(json.dumps(manifest).encode())
    files.move(aside, target)


def _live(path: str) -> tuple[int, dict]:
    number, manifest = _latest(path)
    if manifest is None or manifest["dropped"]:
        raise ValueError(f"there is no collection at {path}")
    return number, manifest


@dataclass
class File(InputPartition):
    name: str


@dataclass
class Written(WriterCommitMessage):
    files: list


class _Reader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path, schema
        _, self.manifest = _live(path)
        self.files = self.manifest["files"]

    def pushFilters(self, filters):
        """Equality and membership of the scalar field choose files; they hold for all their rows, so Spark need not check again."""
        for f in filters:
            known = f.attribute == (self.manifest["field"],) if isinstance(f, (EqualTo, In)) else False
            if not known:
                yield f
                continue
            wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.files = [x for x in self.files if x["value"] is not None and x["value"] in wanted]

    def partitions(self):
        return [File(x["name"]) for x in self.files]

    def read(self, partition: File | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # nothing to read
            return
        files, root = _place(self.path)
        with files.open_input_file(f"{root}/data/{partition.name}") as f:
            yield from pq.ParquetFile(f).iter_batches(columns=self.schema.names)


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.overwrite = path, overwrite
        self.number, self.manifest = _live(path)
        if sorted(schema.names) != sorted(StructType.fromJson(self.manifest["schema"]).names):
            raise ValueError(f"the collection has other columns than {schema.names}")

    def _checked(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        vec, dim = self.manifest["vec"], self.manifest["dim"]
        sizes = pc.list_value_length(batch.column(vec))
        if not pc.all(pc.fill_null(pc.equal(sizes, dim), False)).as_py() and batch.num_rows:
            raise ValueError(f"a vector is not of dimension {dim}")
        return batch

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = _place(self.path)
        held: dict[object, list[pa.RecordBatch]] = {}
        made: list[dict] = []

        def flush(value):
            table = pa.Table.from_batches(held.pop(value))
            name = f"{uuid.uuid4().hex}.parquet"
            files.create_dir(f"{root}/data", recursive=True)
            with files.open_output_stream(f"{root}/data/{name}") as f:
                pq.write_table(table, f)
            made.append({"name": name, "value": value, "rows": table.num_rows})

        for batch in iterator:
            column = self._checked(batch).column(self.manifest["field"])
            for value in pc.unique(column).to_pylist():
                same = pc.is_null(column) if value is None else pc.equal(column, pa.scalar(value, column.type))
                held.setdefault(value, []).append(batch.filter(pc.fill_null(same, False)))
                if sum(b.num_rows for b in held[value]) >= ROWS:
                    flush(value)
            # values that come seldom do not pile up
            if sum(b.num_rows for parts in held.values() for b in parts) >= 4 * ROWS:
                for value in list(held):
                    flush(value)
        for value in list(held):
            flush(value)
        return Written(made)

    def commit(self, messages) -> None:
        new = [f for m in messages if m is not None for f in m.files]
        _publish(self.path, self.number + 1, {**self.manifest, "files": new if self.overwrite else self.manifest["files"] + new})

    def abort(self, messages) -> None:
        """Files of tasks that finished go at once; those of tasks that failed half-way by ``vacuum``."""
        files, root = _place(self.path)
        for f in [f for m in messages if m is not None for f in m.files]:
            files.delete_file(f"{root}/data/{f['name']}")


class CollectionSource(DataSource):
    """The data source behind ``FORMAT``; its one option is ``path``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return StructType.fromJson(_live(self.options["path"])[1]["schema"])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool):
        return _Writer(self.options["path"], schema, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CollectionSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


class Collection:
    """A named place for vectors of one dimension with a scalar ``field`` (number or text)."""

    def __init__(self, spark: SparkSession, path: str):
        register(spark)
        self.spark, self.path = spark, path

    def exists(self) -> bool:
        _, manifest = _latest(self.path)
        return manifest is not None and not manifest["dropped"]

    def create(self, schema: StructType, dim: int, field: str, vec: str = "vec", drop_if_exists: bool = False) -> None:
        """A new, empty collection; fails if there is one, unless that is to go."""
        if self.exists() and not drop_if_exists:
            raise ValueError(f"there is a collection at {self.path}")
        number, _ = _latest(self.path)
        _publish(self.path, number + 1, {"dropped": False, "schema": json.loads(schema.json()), "dim": dim, "field": field, "vec": vec, "files": []})

    def drop(self) -> None:
        number, manifest = _live(self.path)
        _publish(self.path, number + 1, {**manifest, "dropped": True, "files": []})

    def insert(self, df: DataFrame, replace: bool = False) -> None:
        """Add rows, all or none; ``replace`` puts them in the place of those there."""
        names = StructType.fromJson(_live(self.path)[1]["schema"]).names
        df.select(*names).write.format(FORMAT).option("path", self.path).mode("overwrite" if replace else "append").save()

    def rows(self) -> DataFrame:
        return self.spark.read.format(FORMAT).option("path", self.path).load()

    def vacuum(self) -> None:
        """Delete data files that the latest manifest does not list; call it when nothing reads or writes."""
        _, manifest = _latest(self.path)
        files, root = _place(self.path)
        keep = {f["name"] for f in (manifest or {"files": []})["files"]}
        for info in files.get_file_info(fs.FileSelector(f"{root}/data", allow_not_found=True)):
            if info.base_name not in keep:
                files.delete_file(info.path)

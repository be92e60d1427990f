"""Embeddings of node groups and compressed or clustered vector search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F, types as T

from tessera.functions import text as tx
from tessera.operators.search import CELLS_PER_BLOCK, Scorer, block_search, vector_scorer, within_cells
from tessera.operators.term_groups import idf_of, term_groups, terms_with_idf
from tessera.session import work_path


def mean_vectors(df: DataFrame, by: list[str], vec: str, weight: str | None = None) -> DataFrame:
    """Mean vector per group, one average per dimension: no row is multiplied, all combined map-side.

    Vectors of different lengths end the job.
    """
    first = df.select(F.size(vec)).where(F.col(vec).isNotNull()).first()
    dim = first[0] if first else 0
    even = F.when(F.col(vec).isNull() | (F.size(vec) == dim), F.col(vec)).otherwise(F.raise_error(F.lit("vectors of different lengths")))
    value = lambda i: even[i].cast("double")
    if weight is None:
        means = [F.avg(value(i)).alias(f"m{i}") for i in range(dim)]
    else:
        means = [(F.sum(value(i) * F.col(weight)) / F.sum(weight)).alias(f"m{i}") for i in range(dim)]
    return df.groupBy(*by).agg(*means).select(*by, F.array(*[F.col(f"m{i}") for i in range(dim)]).alias("vec"))


def hashed_vectors(nodes: DataFrame, text: str, dim: int, out: str = "vec") -> DataFrame:
    """Feature hashing of words into ``dim`` buckets, L2-normalised: the default without a model."""
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for buckets in batches:
            rows = []
            for b in buckets:
                v = np.bincount(np.asarray(b, dtype=np.int64), minlength=dim).astype(float)
                length = np.linalg.norm(v)
                rows.append(v / length if length else v)
            yield pd.Series(rows)

    buckets = F.transform(tx.words(F.col(text)), lambda w: F.pmod(F.crc32(w.cast("binary")), F.lit(dim)).cast("int"))
    return nodes.withColumn(out, encode(buckets))


def embed(nodes: DataFrame, text: str, models: dict[str, object]) -> DataFrame:
    """Long form ``..., embed_key, vec``; a model is a function DataFrame -> DataFrame adding ``vec``."""
    parts = [model(nodes).withColumn("embed_key", F.lit(key)) for key, model in models.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def missing_vectors(nodes: DataFrame, stored: DataFrame, text: str = "content") -> DataFrame:
    """Distinct texts without a stored vector: ``hash, content``."""
    texts = nodes.select(F.sha2(F.col(text), 256).alias("hash"), F.col(text).alias("content"))
    distinct = texts.groupBy("hash").agg(F.first("content").alias("content"))  # copies go map-side
    return distinct.join(stored.select("hash"), "hash", "left_anti")


def sparse_vectors(nodes: DataFrame, keys: list[str], words: str = "words") -> DataFrame:
    """Exploded TF-IDF rows ``keys, term, tf, w`` with idf ``ln(N / df)``."""
    groups = term_groups(nodes, keys, words)
    return terms_with_idf(groups, idf_of(groups, nodes)).select(*keys, "term", "tf", (F.col("tf") * F.col("idf")).alias("w"))


# ---- inverted file -----------------------------------------------------------------------------

def train_cells(nodes: DataFrame, cells: int, vec: str = "vec", seed: int = 7) -> KMeansModel:
    points = nodes.select(array_to_vector(F.col(vec).cast("array<double>")).alias("features"))
    return KMeans(k=cells, seed=seed, maxIter=10).fit(points)


def squared_distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Rows x centers, by one matrix product."""
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ centers.T) + (centers * centers).sum(axis=1)[None, :]


def _slices(rows: int, width: int) -> Iterator[slice]:
    """Runs of rows whose rows x width array stays small."""
    step = max(1, CELLS_PER_BLOCK // max(1, width))
    return (slice(at, at + step) for at in range(0, rows, step))


def nearest_of(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Number of the nearest center of every row, the smaller one at ties."""
    out = np.empty(len(x), np.int64)
    for part in _slices(len(x), len(centers)):
        out[part] = squared_distances(x[part], centers).argmin(axis=1)
    return out


def nearest_centers(df: DataFrame, centers: np.ndarray, vec: str, n: int, out: str) -> DataFrame:
    """The ``n`` nearest centers (Euclidean) of every vector, nearest first."""
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def near(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        x = np.stack(vectors.to_numpy()).astype(float)
        rows = []
        for part in _slices(len(x), len(centers)):
            rows.extend(np.argsort(squared_distances(x[part], centers), axis=1, kind="stable")[:, :n].astype(np.int32))
        return pd.Series(rows)

    return df.withColumn(out, near(vec))


def write_cells(nodes: DataFrame, model: KMeansModel, keys: list[str], vec: str = "vec") -> str:
    """Store the nodes partitioned by cell.

    The rebalance hint brings small cells together and splits large ones by size, so a cell with
    a third of all rows is many files and many read tasks.
    """
    path = work_path(nodes.sparkSession, "cells")
    centers = np.array(model.clusterCenters())
    placed = nearest_centers(nodes.select(*keys, F.col(vec).alias("vec")), centers, "vec", 1, "near")
    (placed.withColumn("cell", F.col("near")[0]).drop("near").hint("rebalance", F.col("cell"))
     .write.partitionBy("cell").parquet(path))
    return path


def cell_search(path: str, model: KMeansModel, queries: DataFrame, k: int, keys: list[str], nprobe: int,
                metric: str = "cosine", qid: str = "qid") -> DataFrame:
    """Search only the ``nprobe`` nearest cells of each query; unprobed partitions are not read."""
    centers = np.array(model.clusterCenters())
    probed = nearest_centers(queries.select(qid, "vec"), centers, "vec", nprobe, "cells")
    nodes = queries.sparkSession.read.parquet(path)
    used = [r[0] for r in probed.select(F.explode("cells")).distinct().collect()]  # at most one per cell
    nodes = nodes.filter(F.col("cell").isin(used))
    scorer = within_cells(vector_scorer(metric))
    return block_search(nodes, probed, scorer, k, keys, ["vec", "cell"], qid)


# ---- product quantisation ----------------------------------------------------------------------

def train_codebooks(nodes: DataFrame, parts: int, codes: int, vec: str = "vec", seed: int = 7) -> np.ndarray:
    """k-means per sub-vector: ``parts x codes x width``."""
    dim = nodes.select(F.size(vec)).first()[0]
    if dim % parts:
        raise ValueError(f"{dim} dimensions do not divide into {parts} parts")
    width = dim // parts
    books = []
    for p in range(parts):
        points = nodes.select(array_to_vector(
            F.slice(vec, p * width + 1, width).cast("array<double>")).alias("features"))
        books.append(KMeans(k=codes, seed=seed, maxIter=8).fit(points).clusterCenters())
    return np.array(books)


def encode_codes(nodes: DataFrame, books: np.ndarray, keys: list[str], vec: str = "vec") -> DataFrame:
    """``keys, codes``: the nearest center per sub-vector."""
    parts, _, width = books.shape

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def encode(vectors: pd.Series) -> pd.Series:
        x = np.stack(vectors.to_numpy()).astype(float).reshape(len(vectors), parts, width)
        codes = [nearest_of(x[:, p], books[p]) for p in range(parts)]
        return pd.Series(list(np.stack(codes, axis=1).astype(np.int32)))

    return nodes.select(*keys, encode(F.col(vec)).alias("codes"))


def _prepare_codes(queries: pa.Table, args: dict) -> np.ndarray:
    books = args["books"]
    parts, _, width = books.shape
    q = np.array(queries["vec"].to_pylist(), float).reshape(-1, parts, width)
    return ((q[:, :, None, :] - books[None]) ** 2).sum(axis=3)


def _score_codes(table: np.ndarray, batch: pa.RecordBatch, args: dict) -> np.ndarray:
    codes = batch.column(batch.schema.get_field_index("codes")).flatten().to_numpy(zero_copy_only=False)
    parts = args["books"].shape[0]
    codes = codes.reshape(-1, parts)
    total = np.zeros((len(codes), len(table)))
    for p in range(parts):
        total += table[:, p, :].T[codes[:, p]]
    return np.sqrt(total)


def code_scorer(books: np.ndarray) -> Scorer:
    """Euclidean distance from the summed distance table of a query."""
    return Scorer(_prepare_codes, _score_codes, {"books": books}, descending=False)


def code_search(coded: DataFrame, nodes: DataFrame, queries: DataFrame, books: np.ndarray, k: int,
                keys: list[str], survivors: int, qid: str = "qid") -> DataFrame:
    """Distances by codes first, then exact distances of the ``survivors`` best per query."""
    from tessera.functions.vector import euclid
    from tessera.operators.search import top_k

    first = block_search(coded, queries, code_scorer(books), survivors, keys, ["codes"], qid)
    exact = (first.select(qid, *keys).join(nodes.select(*keys, F.col("vec").alias("nv")), keys)
             .join(queries.select(qid, F.col("vec").alias("qv")), qid))
    scored = exact.select(qid, *keys, F.round(euclid(F.col("qv"), F.col("nv")), 6).alias("score"))
    return top_k(scored, [qid], k, keys, descending=False)

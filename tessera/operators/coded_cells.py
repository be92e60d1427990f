"""Stored vector cells with short codes: what is near is found from the codes and scored exactly.

A vector is placed in its nearest cell; what is left after taking the cell's centre away is cut into parts, of widths that differ by one
at most, and each part becomes the number of its nearest code vector: one byte a part. The squared distance of a query to a row is taken as

    |q - c|^2  +  (|r|^2 + 2 c.s)  -  2 q.s

with centre ``c``, the row's true rest ``r`` and its coded rest ``s``. The first term is one number per query and cell, the second is
stored with the row, the third is a sum of table entries that are the same for all cells. As the length of ``r`` is the true one, the error
is 2 (q - c).(r - s), at most 2 |q - c| |r - s|; ``|r - s|`` is stored too. A first scan reads keys and codes of the probed cells and scores
the best by code exactly, which gives each query a distance its k-th result cannot exceed. A second scan scores exactly what may lie within
it, so the result is the exact top k of the probed cells, however coarse the codes are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tessera.functions.vector import cosine, euclid
from tessera.operators.search import Scorer, _column, _matrix, block_search, top_k
from tessera.operators.vectors import nearest_centers, nearest_of, squared_distances
from tessera.session import cut, work_path

STORED = ("cell", "code", "bias", "err", "vec")


class CodedCells:
    """A stored index of vectors below ``path``.

    ``metric`` is ``cosine`` (vectors are made unit ones before they are placed) or ``l2``. Centres and code vectors are fitted on about
    ``sample`` rows, picked by a hash of the keys; every row is stored. Null vectors, those with a null or non-finite value, those shorter
    than the longest, and for cosine zero ones are not stored, and such queries find nothing. Columns besides keys and vector are ignored.
    """

    def __init__(self, spark: SparkSession, keys: list[str], cells: int = 64, parts: int = 8, codes: int = 256, metric: str = "cosine",
                 sample: int = 100_000, seed: int = 7, path: str | None = None):
        if not 1 <= codes <= 256:
            raise ValueError("a code is one byte: 1 to 256 codes")
        if metric not in ("cosine", "l2"):
            raise ValueError(f"unknown metric {metric}")
        if set(keys) & set(STORED):
            raise ValueError(f"keys may not be named {', '.join(STORED)}")
        self.spark, self.keys, self.path = spark, keys, path or work_path(spark, "coded-cells")
        self.cells, self.parts, self.codes, self.metric, self.sample, self.seed = cells, parts, codes, metric, sample, seed
        self.centers: np.ndarray | None = None
        self.books: list[np.ndarray] = []
        self.bounds: list[int] = []

    def _sound(self, rows: DataFrame, vec: str, width: int) -> DataFrame:
        """Rows with a usable vector in ``vec``, as the index compares it."""
        inf = F.lit(float("inf"))
        bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == inf)
        rows = rows.withColumn(vec, F.col(vec).cast("array<double>")).filter((F.size(vec) == width) & ~F.exists(vec, bad))
        if self.metric == "l2":
            return rows
        norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda a, v: a + v * v))
        return rows.withColumn("_norm", norm).filter("_norm > 0").withColumn(vec, F.transform(vec, lambda v: v / F.col("_norm"))).drop("_norm")

    def _fit(self, points: DataFrame, k: int) -> np.ndarray:
        """``k`` centres, or the points themselves if no more of them differ."""
        few = points.select("vec").distinct().limit(k + 1).toArrow()
        if few.num_rows <= k:
            return _matrix(few["vec"])
        model = KMeans(k=k, seed=self.seed, maxIter=10).fit(points.select(array_to_vector("vec").alias("features")))
        return np.array(model.clusterCenters())

    def write(self, nodes: DataFrame, vec: str = "vec") -> None:
        """Fit, code and store all nodes, partitioned by cell; a large cell becomes several files."""
        rows = nodes.select(*self.keys, F.col(vec).alias("vec"))
        n, width = rows.agg(F.count("*"), F.max(F.size("vec"))).first()
        width = width or 0
        sound = self._sound(rows, "vec", width)
        every = max(1, n // self.sample)
        picked = sound.filter(F.pmod(F.xxhash64(*self.keys), F.lit(every)) == 0).select("vec").persist()
        if width < 1 or picked.isEmpty():
            # so few usable vectors that the hash picked none
            picked.unpersist()
            picked = sound.select("vec").limit(self.sample).persist()
        if width > 0 and not picked.isEmpty():
            if not 1 <= self.parts <= width:
                raise ValueError(f"{width} dimensions do not give {self.parts} parts")
            self.centers = self._fit(picked, self.cells)
            self.bounds = [width * p // self.parts for p in range(self.parts + 1)]
            rest = picked.select(_rest(self.centers)("vec").alias("vec")).persist()
            self.books = [self._fit(rest.select(F.slice("vec", a + 1, b - a).alias("vec")), self.codes)
                          for a, b in zip(self.bounds, self.bounds[1:])]
            rest.unpersist()
        picked.unpersist()
        schema = T.StructType([*[rows.schema[c] for c in self.keys], T.StructField("cell", T.IntegerType()),
                               T.StructField("code", T.BinaryType()), T.StructField("bias", T.DoubleType()),
                               T.StructField("err", T.DoubleType()), T.StructField("vec", T.ArrayType(T.DoubleType()))])
        if self.centers is None:
            self.spark.createDataFrame([], schema).write.parquet(self.path)
            return
        coded = sound.mapInArrow(_code_task(self.keys, self.centers, self.books, self.bounds), schema)
        coded.hint("rebalance", F.col("cell")).write.partitionBy("cell").parquet(self.path)

    def rows(self) -> DataFrame:
        """The stored rows: keys, code, bias, err, vec, cell."""
        return self.spark.read.parquet(self.path)

    def search(self, queries: DataFrame, k: int, nprobe: int, survivors: int, vec: str = "vec", qid: str = "qid",
               certain: bool = True) -> DataFrame:
        """qid, keys, score (exact, six digits), rk: the exact top k of the ``nprobe`` nearest cells of every query.

        ``survivors`` rows per query, the nearest by code, are scored first. Without ``certain`` the search ends there: no second scan, but
        a row that its code places behind the survivors is lost.
        """
        stored = self.rows()
        asked = queries.select(qid, F.col(vec).alias("vec"))
        if self.centers is None:
            types = [queries.schema[qid], *[stored.schema[c] for c in self.keys], T.StructField("score", T.DoubleType()),
                     T.StructField("rk", T.IntegerType())]
            return self.spark.createDataFrame([], T.StructType(types))
        near = self.metric == "l2"
        asked = nearest_centers(self._sound(asked, "vec", self.centers.shape[1]), self.centers, "vec", nprobe, "cells")
        used = [r[0] for r in asked.select(F.explode("cells")).distinct().collect()]  # at most one per cell
        probed = stored.filter(F.col("cell").isin(used))
        args = {"centers": self.centers, "books": self.books, "bounds": self.bounds, "metric": self.metric}
        first = block_search(probed, asked, Scorer(_prepare, _score, args, descending=False), survivors, [*self.keys, "cell"],
                             ["code", "bias"], qid)
        pairs = (first.select(qid, *self.keys, "cell").join(probed.select(*self.keys, "cell", "vec"), [*self.keys, "cell"])
                 .join(asked.select(qid, F.col("vec").alias("_q")), qid))
        measure = euclid if near else cosine
        scored = pairs.select(qid, *self.keys, F.round(measure(F.col("_q"), F.col("vec")), 6).alias("score"))
        best = top_k(scored, [qid], k, self.keys, descending=not near)
        if not certain:
            return best
        last = best.filter(F.col("rk") == k).select(qid, F.col("score").alias("last"))
        limited = cut(asked.join(last, qid, "left"))
        return block_search(probed, limited, Scorer(_prepare_exact, _score_exact, args, descending=not near), k, self.keys,
                            ["cell", "code", "bias", "err", "vec"], qid)


def _rest(centers: np.ndarray):
    """A vector without its nearest centre."""
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def rest(vectors):
        import pandas as pd

        x = np.stack(vectors.to_numpy()).astype(float)
        return pd.Series(list(x - centers[nearest_of(x, centers)]))

    return rest


def _code_task(keys: list[str], centers: np.ndarray, books: list[np.ndarray], bounds: list[int]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(_column(batch, "vec"), centers.shape[1])
            cell = nearest_of(x, centers)
            home = centers[cell]
            rest = x - home
            lost = np.zeros(len(x))
            code, bias = np.empty((len(x), len(books)), np.uint8), (rest * rest).sum(axis=1)
            for p, (book, a, b) in enumerate(zip(books, bounds, bounds[1:])):
                code[:, p] = nearest_of(rest[:, a:b], book)
                coded = book[code[:, p]]
                bias += 2 * (home[:, a:b] * coded).sum(axis=1)
                lost += ((rest[:, a:b] - coded) ** 2).sum(axis=1)
            columns = {**{c: _column(batch, c) for c in keys}, "cell": pa.array(cell, pa.int32()),
                       "code": pa.array([row.tobytes() for row in code], pa.binary()), "bias": pa.array(bias), "err": pa.array(np.sqrt(lost)),
                       "vec": _column(batch, "vec")}
            yield pa.RecordBatch.from_pydict(columns)

    return task


def _prepare(queries: pa.Table, args: dict) -> tuple[np.ndarray, list[np.ndarray]]:
    centers, bounds = args["centers"], args["bounds"]
    q = _matrix(queries["vec"], centers.shape[1])
    to_cell = np.full((len(q), len(centers)), np.nan)
    away = squared_distances(q, centers)
    for i, cells in enumerate(queries["cells"].to_pylist()):
        to_cell[i, cells] = away[i, cells]  # other cells stay without a score
    return to_cell, [-2 * q[:, a:b] @ book.T for book, a, b in zip(args["books"], bounds, bounds[1:])]


def _estimate(state: tuple[np.ndarray, list[np.ndarray]], batch: pa.RecordBatch) -> np.ndarray:
    """Squared distances by code, NaN outside a query's cells."""
    to_cell, tables = state
    parts = len(tables)
    fixed = _column(batch, "code").cast(pa.binary(parts))
    code = np.frombuffer(fixed.buffers()[1], np.uint8)[fixed.offset * parts:][:len(fixed) * parts].reshape(-1, parts)
    cell = _column(batch, "cell").to_numpy(zero_copy_only=False)
    total = to_cell.T[cell] + _column(batch, "bias").to_numpy(zero_copy_only=False)[:, None]
    for p, table in enumerate(tables):
        total += table.T[code[:, p]]
    return total


def _score(state: tuple[np.ndarray, list[np.ndarray]], batch: pa.RecordBatch, args: dict) -> np.ndarray:
    return np.sqrt(np.maximum(_estimate(state, batch), 0))


ROUNDED = 4e-6  # last scores come rounded to six digits


def _prepare_exact(queries: pa.Table, args: dict) -> tuple:
    """Estimates, the query vectors, and the squared distance each query's results lie within."""
    q = _matrix(queries["vec"], args["centers"].shape[1])
    last = queries["last"].to_numpy().astype(float)  # NaN: fewer than k found
    limit = 2 - 2 * last + ROUNDED if args["metric"] == "cosine" else (last + ROUNDED) ** 2
    return _prepare(queries, args), q, np.where(np.isnan(limit), np.inf, limit)


def _score_exact(state: tuple, batch: pa.RecordBatch, args: dict) -> np.ndarray:
    coded, q, limit = state
    cell = _column(batch, "cell").to_numpy(zero_copy_only=False)
    err = _column(batch, "err").to_numpy(zero_copy_only=False)
    estimate = _estimate(coded, batch)
    # rounding of the sums, in units of the numbers summed
    slack = 1e-9 * (1 + np.abs(estimate))
    open_ = estimate - 2 * np.sqrt(np.maximum(coded[0].T[cell], 0)) * err[:, None] - slack <= limit[None, :]
    out = np.full(open_.shape, np.nan)
    x = _matrix(_column(batch, "vec"), q.shape[1])
    for j in np.flatnonzero(open_.any(axis=0)):
        at = np.flatnonzero(open_[:, j])
        out[at, j] = x[at] @ q[j] if args["metric"] == "cosine" else np.sqrt(((x[at] - q[j]) ** 2).sum(axis=1))
    return out

"""Near-duplicate vectors by randomised-rotation binary codes.

A unit vector is turned by a random rotation; the signs of its elements are its code, and the inner product of code and
vector is stored as the code's correction factor. Divided by it, the product of a code with another turned vector is an unbiased
estimate of the two vectors' cosine, with a known error. A pair whose upper bound stays below the threshold is done with;
the others are computed exactly, in double precision.

Pairs meet in buckets: the signs of several rotations make up bands, and vectors with an equal band share a bucket. There are so many bands
that a pair at the threshold misses all of them with a chance of MISS, and a band has a bit for every doubling of the
number of vectors, so buckets do not fill up as the table grows. A bucket that is large all the same is dealt out in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import components
from tessera.session import cut

SEED = 31_337
MISS = 1e-4
SURE = 4.0  # bounds hold for all but about 1 in 30,000 pairs
BLOCK = 1_000  # vectors of a bucket that one task compares with as many others


@lru_cache(maxsize=64)
def rotation(dim: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same in all tasks."""
    q, r = np.linalg.qr(np.random.default_rng((SEED, dim, number)).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def bands(vectors: int, threshold: float) -> tuple[int, int]:
    """(number of bands, bits of a band)."""
    bits = min(32, max(12, math.ceil(math.log2(max(2, vectors)))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return math.ceil(math.log(MISS) / math.log(1 - same)), bits


def band_values(unit: np.ndarray, count: int, bits: int) -> np.ndarray:
    """Band values (vectors x count) from the signs under as many rotations as it takes."""
    dim = unit.shape[1]
    signs = np.concatenate([unit @ rotation(dim, r) >= 0 for r in range(-(-count * bits // dim))], axis=1)[:, :count * bits]
    return signs.reshape(len(unit), count, bits) @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def code(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign code (True for +) under the first rotation, and the correction factor."""
    turned = unit @ rotation(unit.shape[1], 0)
    return turned >= 0, np.abs(turned).sum(axis=1) / math.sqrt(unit.shape[1])


def upper_bound(signs: np.ndarray, factor: np.ndarray, turned: np.ndarray) -> np.ndarray:
    """Estimate plus error bound of the cosine, row by row: codes against turned vectors."""
    dim = signs.shape[1]
    estimate = np.einsum("ij,ij->i", np.where(signs, 1.0, -1.0), turned) / math.sqrt(dim) / factor
    return estimate + SURE * np.sqrt(np.maximum(0, 1 - factor ** 2)) / factor / math.sqrt(max(1, dim - 1))


def _unit(vectors: np.ndarray) -> np.ndarray:
    # scaled first, so that tiny and huge elements keep their squares
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors ** 2).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of equal length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _coded(count: int, bits: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index("vector"))
            sizes = vectors.value_lengths().to_numpy()
            for size in np.unique(sizes):
                rows = pa.array(np.flatnonzero(sizes == size))
                part = batch.take(rows)
                unit = _unit(_matrix(vectors.take(rows)))
                signs, factor = code(unit)
                values = band_values(unit, count, bits)
                packed = [r.tobytes() for r in np.packbits(signs, axis=1)]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, count, dtype=np.int32)), pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(packed, pa.binary()), pa.array(factor), lists], names=[*part.schema.names, "code", "factor", "bands"])

    return work


def _compared(threshold: float):
    """Pairs within the runs of equal keys of sorted rows."""
    def pairs(rows: pa.Table) -> pa.RecordBatch | None:
        if len(rows) < 2:
            return None
        unit = _unit(_matrix(rows["vector"].combine_chunks()))
        dim = unit.shape[1]
        turned = unit @ rotation(dim, 0)
        signs = np.unpackbits(np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8).reshape(len(rows), -1), axis=1)[:, :dim].astype(bool)
        factor, node, group = rows["factor"].to_numpy(), rows["node"].to_numpy(), rows["group"].to_numpy()
        block, cross, band = rows["block"].to_numpy(), rows["cross"].to_numpy(), rows["band"].to_numpy()
        values = _matrix(rows["bands"].combine_chunks())
        found = []
        for d in range(1, len(rows)):
            i = np.flatnonzero(group[:-d] == group[d:])
            if not len(i):
                break
            j = i + d
            use = ~cross[i] | (block[i] != block[j])  # blocks meet once; within themselves elsewhere
            i, j = i[use], j[use]
            open_ = (upper_bound(signs[i], factor[i], turned[j]) >= threshold) & (upper_bound(signs[j], factor[j], turned[i]) >= threshold)
            i, j = i[open_], j[open_]
            # of all the buckets a pair shares, the first reports it
            first = (values[i] == values[j]).argmax(axis=1) == band[i] if len(i) else np.zeros(0, bool)
            i, j = i[first], j[first]
            good = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
            found.append(np.sort(np.stack([node[i[good]], node[j[good]]], axis=1), axis=1))
        out = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], names=["a", "b"]) if len(out) else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            group = table["group"].to_numpy()
            cut_at = len(group) - int((group[::-1] != group[-1]).argmax()) if group[0] != group[-1] else 0
            # whole groups only; a group has about 2 x BLOCK rows at most
            yield from _slices(table.slice(0, cut_at))
            rest = table.slice(cut_at)
            held = rest.to_batches()
        if held:
            yield from _slices(pa.Table.from_batches(held))

    def _slices(table: pa.Table):
        if not len(table):
            return
        sizes = pc.list_value_length(table["vector"]).to_numpy()
        group = table["group"].to_numpy()
        edges = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1])]))
        start = 0
        while start < len(table):
            # groups of one vector size, about 4,096 rows
            change = np.flatnonzero(sizes[start:] != sizes[start])
            limit = start + (int(change[0]) if len(change) else len(table) - start)
            later = edges[(edges > start) & (edges <= limit)]
            far = later[later <= start + 4_096]
            end = limit if limit - start <= 4_096 else int(far[-1]) if len(far) else int(later[0]) if len(later) else limit
            made = pairs(table.slice(start, end - start))
            if made is not None:
                yield made
            start = end

    return work


def near_vectors(rows: DataFrame, threshold: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(key, n_links, component_id, kept) of every row.

    Vectors are linked if their labels are equal and their cosine, in double precision, reaches ``threshold``. n_links
    are the other rows linked directly, component_id the smallest key that links lead to, kept tells key = component_id.
    A null label, a null, empty or zero vector, or one with null or non-finite elements is linked with nothing, nor are vectors
    of different lengths. Equal vectors are compared once and counted as often as they occur; equal keys are rows of their own.
    """
    v = F.col("vector")
    sound = F.col("label").isNotNull() & F.coalesce(F.size(v) > 0, F.lit(False)) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    base = rows.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"), F.monotonically_increasing_id().alias("uid"))
    base = cut(base.withColumn("sound", F.coalesce(sound, F.lit(False))).withColumn("h1", F.xxhash64("vector")).withColumn("h2", F.xxhash64(F.lit(1), "vector")))
    same = ["label", "h1", "h2"]
    # a node per distinct vector and label
    groups = cut(base.where("sound").groupBy(*same).agg(F.min("uid").alias("node"), F.count("*").alias("n"), F.min("key").alias("low")))
    nodes = groups.select("node", "label").join(base.select(F.col("uid").alias("node"), "vector"), "node")
    count, bits = bands(groups.count(), threshold)
    schema = nodes.withColumns({"code": F.lit(b""), "factor": F.lit(0.0), "bands": F.array(F.lit(0).cast("long"))}).schema
    coded = cut(nodes.mapInArrow(_coded(count, bits), schema))
    bucket = ["label", "dim", "band", "value"]
    spread = coded.select("node", "label", F.size("vector").alias("dim"), F.posexplode("bands").alias("band", "value"))
    full = cut(spread.groupBy(*bucket).agg(F.count("*").alias("size")).where("size > 1").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")))
    member = cut(spread.join(full, bucket).select(*bucket, "node", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")))
    # block against block: every block meets every other once, and itself
    met = member.select(*bucket, "node", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    met = met.select("node", "band", "block", (F.col("block") != F.col("other")).alias("cross"),
                     F.xxhash64(*bucket, F.least("block", "other"), F.greatest("block", "other")).alias("group"))
    work = met.join(coded.select("node", "vector", "code", "factor", "bands"), "node").select("group", "node", "band", "block", "cross", "vector", "code", "factor", "bands")
    links = cut(work.repartition("group").sortWithinPartitions("group", F.size("vector")).mapInArrow(_compared(threshold), "a bigint, b bigint").distinct())
    weight = groups.select(F.col("node").alias("b"), "n")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = cut(both.join(weight, "b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others")))
    roots = components(links)
    placed = groups.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lows = placed.groupBy("root").agg(F.min("low").alias("component"))
    placed = cut(placed.join(lows, "root").join(degree, "node", "left").select(*same, "component", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("links")))
    made = base.where("sound").join(placed, same, "left").select("key", "links", "component")
    made = made.unionByName(base.where("not sound").select("key", F.lit(0).cast("long").alias("links"), F.col("key").alias("component")))
    return made.select(F.col("key").alias(key), F.col("links").alias("n_links"), F.col("component").alias("component_id"), F.col("key").eqNullSafe(F.col("component")).alias("kept"))

"""Near-duplicate documents by bottom-k sketches.

One hash function; a document's sketch are its k smallest shingle hashes. Documents with equal shingle sets are one
node. Inverted lists of retained values give candidate pairs, the union sketch of a pair estimates its Jaccard
similarity, and pairs that may reach the threshold are compared on their full sets.

A list need not hold every retained value of a node. If two sketches share at least s values, they share one among the
rarest ``size - s + 1`` values of either, so only those are listed: a shingle that a third of all documents have is in no list unless
a document has nothing rarer.

A list of more than SHORT nodes is first compared with a few leaders: its most central node, and some picked by hash. What
stays apart from the rest of its list meets new leaders. Only nodes that are in different components after that are compared
with each other: each list's most central node names a cell, a cell's nodes are packed into blocks of bounded size, and
blocks of like set sizes are compared on their full sets. Blocks travel, pairs do not, and only links come out. So a group
of thousands of near copies makes no square of pairs, and no link between components is missed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import hashing
from tessera.llm.components import components
from tessera.llm.scratch import Scratch

K = 64  # retained hashes
SHORT = 12  # longer lists go by leaders
LEADERS = 2
TURNS = 2  # with leaders, before all that is still apart is compared in blocks
BLOCK_ROWS = 128
BLOCK_VALUES = 200_000  # shingles of a block's nodes together, unless one node has more
COLUMNS = 4096  # values that a comparison of two blocks holds at a time
SIGMAS = 4.5  # an estimate may fall short by so many standard deviations
# Fixed value: what separates words.
BLANK = hashing.separators(r"[\x20\x09-\x0D]")
PLACE = np.random.default_rng(11).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the distinct shingle hashes of text t, ascending, are hashes[bounds[t]:bounds[t + 1]].

    A-Z count as a-z. A text of fewer than n words has one shingle, all its words; a text without words has none.
    """
    texts = len(offsets) - 1
    starts, ends, text = hashing.words(data, offsets, BLANK)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(texts + 1, np.int64)
    word = hashing.Prefix(data, hashing.FOLDED).hashes(starts, ends)
    count = np.bincount(text, minlength=texts)
    whole = np.flatnonzero(text[:max(0, len(word) - n + 1)] == text[n - 1:]) if len(word) >= n else np.zeros(0, np.int64)
    h = np.full(len(whole), n, np.uint64)
    for j in range(n):
        h += word[whole + j] * PLACE[j]
    few = np.flatnonzero((count > 0) & (count < n))
    first = np.cumsum(count) - count
    short = np.array([int(count[t]) + sum(int(word[first[t] + j]) * int(PLACE[j]) for j in range(int(count[t]))) for t in few], object)
    short = np.array([int(x) & (2 ** 64 - 1) for x in short], np.uint64)
    owner = np.concatenate([text[whole], few])
    # 63 bits, so that signed columns sort alike
    h = (hashing.mix(np.concatenate([h, short])) >> np.uint64(1)).astype(np.int64)
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
    owner, h = owner[new], h[new]
    return h, np.searchsorted(owner, np.arange(texts + 1))


def _digest(h: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    """16 bytes that stand for the set; None for an empty one."""
    u = h.astype(np.uint64)
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashing.mix(u ^ np.uint64(s)))]) for s in (0x51ED270B35AE, 0x2545F4914F6C)]
    parts = np.stack([s[bounds[1:]] - s[bounds[:-1]] for s in sums], axis=1)
    return [p.tobytes() if b > a else None for p, a, b in zip(parts, bounds[:-1], bounds[1:])]


def _sketches(n: int, k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("__text")
            for start, end, data, offsets in hashing.text_slices(batch.column(at)):
                h, bounds = shingle_hashes(data, offsets, n)
                sizes = np.diff(bounds)
                kept = np.minimum(sizes, k)
                index = np.repeat(bounds[:-1], kept) + np.arange(kept.sum()) - np.repeat(np.cumsum(kept) - kept, kept)
                sketch = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(kept)]).astype(np.int32)), pa.array(h[index]))
                part = batch.slice(start, end - start)
                body = pa.array([None if t is None else zstandard.compress(t.encode()) for t in part.column(at).to_pylist()], pa.binary())
                columns = [body if i == at else part.column(i) for i in range(part.num_columns)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(_digest(h, bounds), pa.binary()), pa.array(sizes.astype(np.int64)), sketch],
                                                 names=[*part.schema.names, "__digest", "__size", "__sketch"])

    return work


def _listed(size: Column, threshold: float, k: int) -> Column:
    """How many of a sketch's rarest values must be listed.

    A partner's set is at most size / threshold. If that fits k, both sketches are whole sets and share
    threshold x size values; else the shared part of two k-sketches is a sample, which may fall short.
    """
    least = max(0.0, threshold - SIGMAS * math.sqrt(threshold * (1 - threshold) / k))
    held = F.least(size, F.lit(k))
    return held - F.when(size <= int(k * threshold), F.ceil(size * threshold - 1e-9)).otherwise(F.floor(held * least)) + 1


def _estimate(a: Column, b: Column, k: int) -> Column:
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, k)
    return F.size(F.array_intersect(union, F.array_intersect(a, b))) / F.size(union)


def _close(pairs: DataFrame, sketches: DataFrame, threshold: float, k: int) -> DataFrame:
    """The pairs (a, b) whose sketches let them reach the threshold."""
    margin = SIGMAS * math.sqrt(threshold * (1 - threshold) / k)
    side = lambda c: sketches.select(F.col("node").alias(c), F.col("sketch").alias(f"sketch_{c}"))
    alike = _estimate(F.col("sketch_a"), F.col("sketch_b"), k) >= threshold - margin
    return pairs.join(side("a"), "a").join(side("b"), "b").where(alike).select("a", "b")


def _verified(scratch: Scratch, near: DataFrame, nodes: DataFrame, n: int, threshold: float) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    body = lambda c: nodes.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, None  # neighbouring rows often share their first text
        for batch in batches:
            a, b, ta, tb = (batch.column(batch.schema.get_field_index(c)) for c in ("a", "b", "text_a", "text_b"))
            good = []
            for i in range(batch.num_rows):
                if a[i].as_py() != last:
                    last, known = a[i].as_py(), _set_of(ta[i].as_py(), n)
                other = _set_of(tb[i].as_py(), n)
                both = len(np.intersect1d(known, other, assume_unique=True))
                good.append(both >= threshold * (len(known) + len(other) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(good))

    texts = near.join(body("b"), "b").join(body("a"), "a").select("a", "b", "text_a", "text_b")
    return scratch.cut(texts.mapInArrow(work, "a bigint, b bigint"))


def _set_of(body: bytes, n: int) -> np.ndarray:
    data = np.frombuffer(zstandard.decompress(body), np.uint8)
    return shingle_hashes(data, np.array([0, len(data)]), n)[0]


def _texts_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("__text")
        texts = pa.array([None if b is None else zstandard.decompress(b).decode() for b in batch.column(at).to_pylist()], pa.string())
        yield batch.set_column(at, "__text", texts)


def _like_sizes(a: str, b: str, threshold: float) -> Column:
    return F.least(a, b) >= threshold * F.greatest(a, b) - 1e-9


def _with_leaders(rows: DataFrame, members: DataFrame, turn: int, threshold: float) -> DataFrame:
    """Pairs (a, b) of ``rows`` with their lists' leaders: the most central of ``members``, and some drawn by hash anew each turn."""
    body = F.struct("node", "size")
    draws = [F.min_by(body, F.struct(F.xxhash64("node", F.lit(turn * LEADERS + i)), "node")).alias(f"d{i}") for i in range(LEADERS)]
    led = members.groupBy("value").agg(F.max_by(body, F.struct("central", "node")).alias("c"), *draws)
    led = led.select("value", F.array_distinct(F.array("c", *[f"d{i}" for i in range(LEADERS)])).alias("leaders"))
    met = rows.join(led, "value").select("node", "size", F.explode("leaders").alias("leader"))
    met = met.where((F.col("node") != F.col("leader.node")) & _like_sizes("size", "leader.size", threshold))
    return met.select(F.least("node", "leader.node").alias("a"), F.greatest("node", "leader.node").alias("b"))


def _in_blocks(scratch: Scratch, split: DataFrame, texts: DataFrame, n: int, threshold: float) -> DataFrame:
    """Links (a, b) between nodes of different components that share a list; at least one of them is ``rest`` there.

    Sets of linked nodes differ in size by the threshold at most, so that a block meets those of its own and the two
    neighbouring ranges of sizes.
    """
    led = split.groupBy("value").agg(F.max_by("node", F.struct("central", "node")).alias("cell"))
    cells = split.join(led, "value").groupBy("cell", "node").agg(F.first("root").alias("root"), F.max("rest").alias("rest"), F.first("size").alias("size"))
    cells = scratch.cut(cells.withColumn("range", F.floor(F.log("size") / -math.log(threshold * 0.9999)).cast("int")))

    def blocks(rows: DataFrame, side: str) -> DataFrame:
        need = F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("size") / BLOCK_VALUES))
        rows = rows.join(rows.groupBy("cell", "range").agg(need.alias("need")), ["cell", "range"])
        rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), F.col("need"))).join(texts.select("node", "text"), "node")
        packed = rows.groupBy("cell", "range", "part").agg(F.collect_list(F.struct("node", "root", "text")).alias(side))
        return packed.select("cell", F.col("range").alias(f"range_{side}"), side)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last, known = None, None  # neighbouring rows often share their first block
            for i in range(batch.num_rows):
                p, q = (batch.column(batch.schema.get_field_index(c))[i].values for c in "pq")
                if last is None or not p.equals(last):
                    last, known = p, _sets_of(p, n)
                yield pa.RecordBatch.from_arrays(list(_links_of(known, _sets_of(q, n), threshold)), names=["a", "b"])

    p, q = blocks(cells.where("rest"), "p"), blocks(cells, "q")
    met = p.join(q, (p["cell"] == q["cell"]) & (F.abs(p["range_p"] - q["range_q"]) <= 1)).select("p", "q")
    return scratch.cut(met.mapInArrow(work, "a bigint, b bigint"))


def _sets_of(block: pa.StructArray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, roots, hashes, bounds) of a block."""
    node, root, bodies = block.flatten()
    texts = [zstandard.decompress(b) for b in bodies.to_pylist()]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    return node.to_numpy(), root.to_numpy(), *shingle_hashes(np.frombuffer(b"".join(texts), np.uint8), offsets, n)


def _links_of(p: tuple, q: tuple, threshold: float) -> tuple[pa.Array, pa.Array]:
    """Links between nodes of two blocks that are in different components."""
    both = np.intersect1d(p[2], q[2])
    shared = np.zeros((len(p[0]), len(q[0])))
    sides = []
    for _, _, h, bounds in (p, q):
        place = np.minimum(np.searchsorted(both, h), max(len(both) - 1, 0))
        held = both[place] == h if len(both) else np.zeros(len(h), bool)
        order = np.argsort(place[held], kind="stable")
        sides.append((place[held][order], np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[held][order], np.diff(bounds)))
    for start in range(0, len(both), COLUMNS):
        part = []
        for place, owner, sizes in sides:
            x, y = np.searchsorted(place, (start, start + COLUMNS))
            m = np.zeros((len(sizes), COLUMNS), np.float32)
            m[owner[x:y], place[x:y] - start] = 1
            part.append(m)
        shared += part[0] @ part[1].T
    union = sides[0][2][:, None] + sides[1][2][None] - shared
    i, j = np.nonzero((shared >= threshold * union - 1e-9) & (p[1][:, None] != q[1][None]))
    return pa.array(np.minimum(p[0][i], q[0][j])), pa.array(np.maximum(p[0][i], q[0][j]))


def near_duplicates(docs: DataFrame, n: int = 5, threshold: float = 0.8, key: str = "doc_id", text: str = "text", k: int = K, with_text: bool = True) -> DataFrame:
    """``docs`` with n_shingles, component_id, kept and first added (columns of these names are replaced).

    Documents are linked if the Jaccard similarity of their sets of n-word shingles reaches ``threshold``; components are
    what links join. component_id is the smallest key of the component, kept tells key = component_id, and ``first`` is
    true for exactly one row of each component. Texts without words (null, empty, blank) have an empty set, are linked with nothing and
    stay. Fewer than n words count as one shingle. Equal keys are separate rows of one key: both may be kept, one is
    first. A null key comes after all others. Sets are compared whole, whatever the texts' length. Without ``with_text`` the
    text column is left out.
    """
    scratch = Scratch(docs.sparkSession)
    plain = [c for c in docs.columns if c not in (text, "n_shingles", "component_id", "kept", "first")]
    rows = docs.select(*plain, F.col(text).alias("__text"), F.monotonically_increasing_id().alias("__uid"))
    schema = rows.withColumns({"__text": F.lit(b""), "__digest": F.lit(b""), "__size": F.lit(0).cast("long"), "__sketch": F.array(F.lit(0).cast("long"))}).schema
    for field in schema:
        field.nullable = True
    base = scratch.cut(rows.mapInArrow(_sketches(n, k), schema))
    lead = F.min(F.struct(F.col(key).isNull().alias("void"), F.col(key).alias("key"), F.col("__uid").alias("uid"))).alias("best")
    # a node per distinct set; texts follow for the row that stands for it
    best = base.where("__digest is not null").groupBy(F.col("__digest").alias("digest")).agg(lead)
    best = scratch.cut(best.select("digest", "best", F.col("best.uid").alias("node")))
    nodes = scratch.cut(base.select(F.col("__uid").alias("node"), F.col("__size").alias("size"), F.col("__sketch").alias("sketch")).join(best.select("node"), "node"))
    values = nodes.select("node", F.explode("sketch").alias("value"))
    shared = scratch.cut(values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1"))
    # values that no other node has are the rarest, and list nothing
    mine = values.join(shared, "value").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("common"))
    listed = mine.join(nodes.select("node", "size"), "node")
    room = _listed(F.col("size"), threshold, k) - (F.least("size", F.lit(k)) - F.size("common"))
    listed = listed.where(room > 0).select("node", "size", F.explode(F.slice("common", F.lit(1), room.cast("int"))).alias("c"))
    listed = scratch.cut(listed.select("node", "size", F.col("c.value").alias("value")))
    scratch.drop(shared)
    lists = listed.groupBy("value").agg(F.count("*").alias("length")).where("length > 1")
    entries = scratch.cut(listed.join(lists, "value"))
    scratch.drop(listed)
    # short lists: all pairs
    x, y = (entries.where(F.col("length") <= SHORT).select("value", F.col("node").alias(c), F.col("size").alias(f"size_{c}")) for c in "ab")
    pairs = x.join(y, (x["value"] == y["value"]) & (F.col("a") < F.col("b")) & _like_sizes("size_a", "size_b", threshold)).select("a", "b")
    # long ones: the node that is in most and longest lists is what the others were copied from, as a rule
    long = entries.where(F.col("length") > SHORT)
    long = scratch.cut(long.join(long.groupBy("node").agg(F.sum("length").alias("central")), "node").select("value", "node", "size", "central"))
    pairs = scratch.cut(pairs.unionByName(_with_leaders(long, long, 0, threshold)).distinct())
    near = scratch.cut(_close(pairs, nodes, threshold, k))
    involved = near.select(F.col("a").alias("node")).union(near.select(F.col("b").alias("node"))).union(long.select("node")).distinct()
    some = scratch.cut(nodes.join(involved, "node").select("node", "sketch"))
    scratch.drop(nodes, entries)
    # hints where texts are moved: the same plan at every size
    small = scratch.cut(base.select(F.col("__uid").alias("node"), F.col("__text").alias("text")).join(some.select("node").hint("merge"), "node"))
    links = _verified(scratch, near, small, n, threshold)
    for turn in range(1, TURNS + 1):
        roots = components(links)
        apart = scratch.cut(long.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
        # lists whose nodes are still in several components; most nodes are in the largest, and pairs within it are never made
        counts = apart.groupBy("value", "root").agg(F.count("*").alias("n"))
        largest = counts.groupBy("value").agg(F.max_by("root", F.struct("n", "root")).alias("largest"), F.count("*").alias("roots"))
        split = apart.join(largest.where("roots > 1"), "value").withColumn("rest", F.col("root") != F.col("largest"))
        split = scratch.cut(split.select("value", "node", "size", "central", "root", "rest"))
        if split.isEmpty() or turn == TURNS:
            break
        new = scratch.cut(_with_leaders(split.where("rest"), split, turn, threshold).distinct().join(pairs, ["a", "b"], "left_anti"))
        near = scratch.cut(_close(new, some, threshold, k))
        links = links.unionByName(_verified(scratch, near, small, n, threshold))
    # what leaders have not joined
    if not split.isEmpty():
        more = _in_blocks(scratch, split, small, n, threshold)
        if not more.isEmpty():
            links = links.unionByName(more)
            roots = components(links)
    grouped = best.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = grouped.groupBy("root").agg(F.min("best").alias("head"))
    heads = scratch.cut(grouped.select("digest", "root").join(heads, "root").select(F.col("digest").alias("__of"), F.col("head").alias("__head")))
    scratch.drop(some, small)
    carried = [*plain, *["__text"] * with_text]
    made = base.select(*carried, "__uid", "__digest", "__size").join(heads.hint("merge"), F.col("__digest") == F.col("__of"), "left")
    empty = F.col("__digest").isNull()
    component = F.when(empty, F.col(key)).otherwise(F.col("__head.key"))
    made = made.select(*carried, F.col("__size").alias("n_shingles"), component.alias("component_id"), F.col(key).eqNullSafe(component).alias("kept"),
                       (empty | (F.col("__head.uid") == F.col("__uid"))).alias("first"))
    if not with_text:
        return made
    order = [c for c in docs.columns if c in plain or c == text]
    back = made.mapInArrow(_texts_back, made.withColumn("__text", F.lit(None).cast("string")).schema)
    return back.withColumnRenamed("__text", text).select(*order, "n_shingles", "component_id", "kept", "first")

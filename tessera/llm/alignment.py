"""Alignment of two tokenizers' tokens over the same bytes.

Tokens of both kinds are ordered by where they end. Each points to the farthest-right token of the other kind that it overlaps, or
to itself if none reaches farther; doubling these pointers until nothing changes leads every token to the last one of its group. Groups are
the smallest stretches that both tokenizers cut at both ends.

How many documents hold a pair of ids linked is counted over all documents. Pairs held by many documents are handed to the tasks, at
most HANDED of them whatever the corpus; all others are joined by pair, each with few documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.packing import _encoding
from tessera.llm.pieces import MARK, load
from tessera.llm.scratch import Scratch

HANDED = 1 << 20  # pairs: 16 MB
BATCH_ITEMS = 2_000_000  # array items of a batch sent on


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every a token and every b token the b token that ends its group. Ends are sorted, and both reach the same last byte."""
    n = len(ends_a)
    over_a = np.searchsorted(ends_b, ends_a)  # the b token with an a token's last byte
    over_b = np.searchsorted(ends_a, ends_b)
    own = np.arange(n, n + len(ends_b))
    step = np.concatenate([n + over_a, np.where(ends_a[over_b] > ends_b, over_b, own)]) if n else own
    while True:
        twice = step[step]
        if np.array_equal(twice, step):
            return step[:n] - n, step[n:] - n
        step = twice


class Aligner:
    """Both tokenizers, their tokens' bytes and the written ids."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = _encoding(path_a), load(path_b)
        bytes_a = {i: t for t, i in self.a._mergeable_ranks.items()}
        self.bytes_a = [bytes_a.get(i, b"") for i in range(self.a.max_token_value + 1)]
        model = self.b.model
        self.bytes_b = [bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace(MARK, " ").encode() for i, name in enumerate(self.b.names)]
        self.size_a, self.size_b = (np.array([len(t) for t in table]) for table in (self.bytes_a, self.bytes_b))
        na, nb = len(self.bytes_a), len(self.bytes_b)
        self.written = [b"%d%s" % (i, end) for n, ends in ((na, (b",", b"|")), (nb, (b",", b";"))) for end in ends for i in range(n)]

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both kinds; none where the text is null or empty, or the tokens' bytes are not blank + text."""
        none = np.empty(0, np.int64)
        # pieces are the text's own characters, so only a marker in the text (read as a blank) or an unknown id changes a byte
        if not text or MARK in text:
            return none, none
        whole = " " + text
        a = np.array(self.a.encode_ordinary(whole), np.int64)
        b = np.frombuffer(b"".join(self.b.encode(text)), "<u4").astype(np.int64)
        size = len(whole.encode())
        if self.size_a[a].sum() != size or self.size_b[b].sum() != size or (b == self.b.model.unk_id()).any():
            return none, none
        return a, b

    def align(self, text: str | None) -> dict[str, np.ndarray]:
        """Per token its id, end and group (numbered from 0); per link its a and b token."""
        a, b = self.tokens(text)
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        last_a, last_b = terminals(ends_a, ends_b)
        group_a, group_b = (np.cumsum(np.diff(last, prepend=last[:1]) != 0) for last in (last_a, last_b))
        # between two neighbouring ends there is one token of each kind
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        ends = ends[np.diff(ends, prepend=0) > 0]
        return {"a": a, "b": b, "end_a": ends_a, "end_b": ends_b, "group_a": group_a, "group_b": group_b,
                "link_a": np.searchsorted(ends_a, ends), "link_b": np.searchsorted(ends_b, ends)}

    def groups_sha256(self, found: dict[str, np.ndarray]) -> str:
        """Hash of ``a1,a2|b1;a3|b2,b3`` over all groups in order; empty without tokens."""
        a, b, ga, gb = (found[k] for k in ("a", "b", "group_a", "group_b"))
        if not len(a):
            return ""
        in_a, in_b = np.bincount(ga), np.bincount(gb)
        ends = [np.append(g[1:] != g[:-1], True) for g in (ga, gb)]
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[ga]] = a + len(self.bytes_a) * ends[0]
        codes[np.arange(len(b)) + np.cumsum(in_a)[gb]] = 2 * len(self.bytes_a) + b + len(self.bytes_b) * ends[1]
        state, step = sha256(), 1 << 18
        for at in range(0, len(codes), step):
            part = b"".join(map(self.written.__getitem__, codes[at:at + step].tolist()))
            state.update(part[:-1] if at + step >= len(codes) else part)
        return state.hexdigest()


@lru_cache(maxsize=2)
def load_both(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _per_text(work, columns: dict[str, pa.DataType]):
    """A function over batches that replaces ``__text`` by the columns ``work`` makes of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest, texts = batch.drop_columns(["__text"]), batch.column("__text")
            start, made, held = 0, [], 0
            for i in range(batch.num_rows):
                made.append(work(texts[i].as_py()))
                held += sum(len(v) for v in made[-1] if isinstance(v, np.ndarray))
                if held > BATCH_ITEMS or i + 1 == batch.num_rows:
                    arrays = [pa.array(list(values), kind) for values, kind in zip(zip(*made), columns.values())]
                    yield pa.RecordBatch.from_arrays([*rest.slice(start, i + 1 - start).columns, *arrays], names=[*rest.schema.names, *columns])
                    start, made, held = i + 1, [], 0
    return run


def align(docs: DataFrame, path_a: str, path_b: str, keep: list[Column | str], text: str = "text") -> DataFrame:
    """Columns ``keep``, then arrays over tokens a, b, end_a, end_b (bytes), group_a, group_b and over links link_a, link_b.

    a encodes blank + text, b the text. Null and empty texts, and texts whose bytes either tokenizer does not give back, have empty
    arrays. Texts are aligned whole; repeated rows get equal results; an empty table stays empty. Names in ``keep`` are free but for these.
    """
    names = ["a", "b", "end_a", "end_b", "group_a", "group_b", "link_a", "link_b"]

    def work(value):
        found = load_both(path_a, path_b).align(value)
        return [found[n] for n in names]

    rows = docs.select(*keep, F.col(text).alias("__text"))
    schema = rows.drop("__text").withColumns({n: F.array(F.lit(0).cast("long")) for n in names}).schema
    return rows.mapInArrow(_per_text(work, dict.fromkeys(names, pa.list_(pa.int64()))), schema)


def _digests(path_a: str, path_b: str):
    def work(value):
        both = load_both(path_a, path_b)
        found = both.align(value)
        pairs, times = np.unique(found["a"][found["link_a"]] << 32 | found["b"][found["link_b"]], return_counts=True)
        groups = int(found["group_b"][-1]) + 1 if len(found["b"]) else 0
        return len(found["a"]), len(found["b"]), groups, len(found["link_a"]), both.groups_sha256(found), pairs, times

    long, longs = pa.int64(), pa.list_(pa.int64())
    return _per_text(work, {"n_a": long, "n_b": long, "n_groups": long, "n_links": long, "groups_sha256": pa.string(), "pairs": longs, "times": longs})


def _handed(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and counts of all pairs from some power of two on, at most ``most`` of them, sorted by pair."""
    sizes = {r.power: r.n for r in counts.groupBy(F.floor(F.log2("n")).alias("power")).agg(F.count("*").alias("n")).collect()}
    least, total = 64, 0
    for power in range(63, -1, -1):
        total += sizes.get(power, 0)
        if total > most:
            break
        least = power
    if not sizes or least > max(sizes):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    rows = counts.where(F.floor(F.log2("n")) >= least).select("pair", "n").toArrow()
    pairs, n = rows["pair"].to_numpy(), rows["n"].to_numpy()
    order = np.argsort(pairs)
    return pairs[order], n[order]


def _sums(pairs: np.ndarray, n: np.ndarray, best: np.ndarray):
    """A function over batches that adds up what the handed pairs give and passes the others on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, times = batch.column("pairs"), batch.column("times")
            offsets = own.offsets.to_numpy()
            offsets, flat, many = offsets - offsets[0], own.flatten().to_numpy(), times.flatten().to_numpy()
            at = np.minimum(np.searchsorted(pairs, flat), max(len(pairs) - 1, 0))
            known = pairs[at] == flat if len(pairs) else np.zeros(len(flat), bool)
            count = np.where(known, n[at], 0) if len(pairs) else np.zeros(len(flat), np.int64)
            top = known & (count == best[flat >> 32])
            sums = [np.diff(np.concatenate([[0], np.cumsum(v)])[offsets]) for v in (many * top, many * count)]
            cuts = pa.array(np.concatenate([[0], np.cumsum(~known)])[offsets].astype(np.int32))
            rest = [pa.ListArray.from_arrays(cuts, pa.array(v[~known])) for v in (flat, many)]
            kept = batch.drop_columns(["pairs", "times"])
            yield pa.RecordBatch.from_arrays([*kept.columns, *map(pa.array, sums), *rest], names=[*kept.schema.names, "n_best", "count_sum", "pairs", "times"])
    return run


def digests(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", handed: int = HANDED) -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document.

    A link's count is the number of rows of ``docs`` that hold its pair of ids linked; n_best counts links whose count is the highest
    of their a id, ties included. Rows without tokens (see ``align``) have zeros and an empty hash. Repeated rows count as documents
    of their own, null keys are kept, other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col(key).alias("__key"), F.monotonically_increasing_id().alias("uid"), F.col(text).alias("__text"))
    numbers, lists = {c: F.lit(0).cast("long") for c in ("n_a", "n_b", "n_groups", "n_links")}, {c: F.array(F.lit(0).cast("long")) for c in ("pairs", "times")}
    schema = rows.drop("__text").withColumns({**numbers, "groups_sha256": F.lit(""), **lists}).schema
    base = scratch.cut(rows.mapInArrow(_digests(path_a, path_b), schema))
    counts = scratch.cut(base.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")))
    # a row per a id: as many as the vocabulary has
    highest = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("best"))
    rows = highest.toArrow()
    best = np.zeros(int(max(rows["a"].to_numpy(), default=0)) + 1, np.int64)
    best[rows["a"].to_numpy()] = rows["best"].to_numpy()
    pairs, n = _handed(counts, handed)
    made = base.drop("pairs", "times").withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long"), **lists}).schema
    summed = scratch.cut(base.mapInArrow(_sums(pairs, n, best), made))
    scratch.drop(base)
    rare = summed.select("uid", F.inline(F.arrays_zip("pairs", "times"))).withColumnsRenamed({"pairs": "pair", "times": "m"})
    rare = rare.join(counts, "pair").withColumn("a", F.shiftright("pair", 32)).join(highest, "a")
    more = rare.groupBy("uid").agg(F.sum(F.when(F.col("n") == F.col("best"), F.col("m")).otherwise(0)).alias("b"), F.sum(F.col("m") * F.col("n")).alias("c"))
    result = summed.drop("pairs", "times").join(more, "uid", "left")
    return result.select(F.col("__key").alias(key), "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("b", F.lit(0))).alias("n_best"),
                         (F.col("count_sum") + F.coalesce("c", F.lit(0))).alias("count_sum"), "groups_sha256")

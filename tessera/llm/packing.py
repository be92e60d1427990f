"""Sum-of-squares packing of documents into token sequences.

Sequences in the making are counted by fill: N(h) of them hold h tokens. A piece of size s goes where the sum of
N(h)^2 becomes smallest: into a sequence of fill h that makes N(h + s) - N(h) smallest, or into a new one. So no fill
gets many open sequences, and every gap size stays in stock.

Pieces are dealt to shards by an even hash, a shard per SHARD_DOCS documents; shards pack on their own, in parallel. What a
shard leaves open is a few sequences, however many documents it has.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAPACITY = 2_048
SHARD_DOCS = 100_000
END_OF_DOCUMENT = 0
# Fixed value: how byte-level BPE files split text before merging.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def _encoding(path: str):
    """Encoder for a byte-level BPE file of the tokenizers library: same ids, several times as fast."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    # byte-level files write each byte as one printable character
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    special = {t["content"]: t["id"] for t in file["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in file["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)


def encode(path: str, text: str) -> np.ndarray:
    """The text's ids, control tokens in it included, and the end of the document."""
    encoding = _encoding(path)
    ids = encoding.encode(text, allowed_special="all", disallowed_special=())
    ids.append(END_OF_DOCUMENT)
    return np.array(ids, "<u4")


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: whole ones, the first may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, tokenizer_path: str, keep: list[Column | str], text: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Columns ``keep``, then piece, start, length, ids_crc32 (and ids) of every document's pieces.

    A null or empty text is one piece with the end token alone. Texts are encoded whole, whatever their length.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("__text")
            # long texts make many ids: write out after so many
            row, columns, held = [], {k: [] for k in ("piece", "start", "length", "ids_crc32", "ids")}, 0
            for i in range(batch.num_rows):
                ids = encode(tokenizer_path, texts[i].as_py() or "")
                for p, (start, length) in enumerate(cut(len(ids), capacity)):
                    own = ids[start:start + length]
                    row.append(i)
                    for k, v in zip(columns, (p, start, length, zlib.crc32(own.tobytes()), own.tolist() if with_ids else None)):
                        columns[k].append(v)
                held += len(ids) if with_ids else 0
                if held > 1_000_000:
                    yield made(batch, row, columns)
                    row, columns, held = [], {k: [] for k in columns}, 0
            if row:
                yield made(batch, row, columns)

    def made(batch, row, columns):
        kept = batch.drop_columns(["__text"]).take(pa.array(row))
        types = {"piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()} | ({"ids": pa.list_(pa.int32())} if with_ids else {})
        return pa.RecordBatch.from_arrays([*kept.columns, *[pa.array(columns[k], t) for k, t in types.items()]], names=[*kept.schema.names, *types])

    rows = docs.select(*keep, F.col(text).alias("__text"))
    more = {"piece": F.lit(0), **{k: F.lit(0).cast("long") for k in ("start", "length", "ids_crc32")}}
    if with_ids:
        more["ids"] = F.array(F.lit(0))
    return rows.mapInArrow(work, rows.drop("__text").withColumns(more).schema)


def pack_sizes(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence number and offset of every size, in the order given, and how many sequences there are."""
    count = np.zeros(capacity + 1)
    cost_here = np.full(capacity + 1, np.inf)  # -N(h) where there is such a sequence
    cost_here[0] = 0.5
    open_at: list[list[int]] = [[] for _ in range(capacity)]
    sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    used = 0
    for i, s in enumerate(sizes.tolist()):
        # half the change of the sum of squares, less 1/2, for each fill to start from
        change = count[s:] + cost_here[:capacity + 1 - s]
        change[capacity - s] -= 0.5
        fill = capacity - s - int(change[::-1].argmin())  # of equal ones the fullest
        if fill:
            where = open_at[fill].pop()
            count[fill] -= 1
            cost_here[fill] = 1 - count[fill] if count[fill] else np.inf
        else:
            where, used = used, used + 1
        sequence[i], offset[i] = where, fill
        if fill + s < capacity:
            open_at[fill + s].append(where)
            count[fill + s] += 1
            cost_here[fill + s] = 1 - count[fill + s]
    return sequence, offset, used


def close_gaps(sizes: np.ndarray, sequence: np.ndarray, offset: np.ndarray, used: int, capacity: int) -> None:
    """Put the contents of open sequences together where they fit, fullest first, by the same rule."""
    fill = np.bincount(sequence, weights=sizes, minlength=used).astype(np.int64)
    left = np.flatnonzero(fill < capacity)
    left = left[np.argsort(-fill[left], kind="stable")]
    moved, at, _ = pack_sizes(fill[left], capacity)
    target, shift = np.arange(used), np.zeros(used, np.int64)
    heads = {int(m): int(q) for m, q, a in zip(moved, left, at) if a == 0}
    for q, m, a in zip(left, moved, at):
        target[q], shift[q] = heads[int(m)], a
    offset += shift[sequence]
    sequence[:] = target[sequence]


def pack(items: DataFrame, docs_count: int, key: str, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """``items`` with sequence_id and offset.

    Items are dealt to shards by a hash of ``key`` and their position in the document. A shard packs them twice, largest
    first and in order of the hash, and keeps what needs fewer sequences: the first wins where small items are many,
    the second where sizes are spread evenly. An empty table gives an empty table.
    """
    shards = max(1, -(-docs_count // SHARD_DOCS))
    dealt = items.withColumn("__order", F.xxhash64(F.col(key), *[F.col(c) for c in ("piece",) if c in items.columns]))
    dealt = dealt.withColumn("__shard", F.pmod(F.col("__order"), F.lit(shards)).cast("int"))
    schema = items.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema

    def work(table: pa.Table) -> pa.Table:
        sizes = table[length].to_numpy().astype(np.int64)
        if len(sizes) and (sizes.min() < 1 or sizes.max() > capacity):
            raise ValueError(f"lengths must lie in 1 to {capacity}")
        by_hash = np.argsort(table["__order"].to_numpy(), kind="stable")
        packings = []
        for order in (by_hash[np.argsort(-sizes[by_hash], kind="stable")], by_hash):
            q, o, used = pack_sizes(sizes[order], capacity)
            close_gaps(sizes[order], q, o, used, capacity)
            packings.append((len(np.unique(q)), order, q, o))
        _, order, q, o = min(packings, key=lambda p: p[0])
        sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
        sequence[order], offset[order] = q, o
        shard = table["__shard"][0].as_py() if len(sizes) else 0
        return (table.drop_columns(["__order", "__shard"]).append_column("sequence_id", pa.array(sequence * shards + shard))
                .append_column("offset", pa.array(offset)))

    return dealt.groupBy("__shard").applyInArrow(work, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and input_ids of every sequence, from ``packed`` pieces with their ids."""
    rows = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return rows.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("input_ids"))


def pack_documents(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Per piece of every document: key, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A null or empty text is one piece of one token. Repeated rows and null keys are packed like any others.
    """
    made = pieces(docs, tokenizer_path, [F.col(key)], text, capacity, with_ids)
    return pack(made, docs.count(), key, capacity=capacity)

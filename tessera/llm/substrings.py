"""Exact removal of repeated 100-byte strings, by blockwise suffix sorting with a difference cover.

A suffix here is what starts at a byte and is at least LENGTH bytes long; suffixes equal in their first LENGTH bytes
are one string. Suffixes go to buckets, a bucket is sorted a block at a time, and of equal suffixes all but the first in
document order are *later*: their LENGTH bytes are removed.

Buckets. Of the ANCHOR-byte strings within a suffix's first LENGTH bytes the one with the smallest hash is its anchor. It
depends on those bytes only, so equal suffixes have equal anchors, in the same place. A bucket holds the suffixes of some
anchors. Anchors that occur once in the corpus are dropped first: no suffix of theirs can have an equal. Neighbouring suffixes mostly share
an anchor, so they travel as one piece of text, about 4 bytes per suffix.

Sorting (a block of bounded size). Suffixes are sorted by their first PREFIX bytes. Long ties are resolved without reading
further: positions whose distance from the anchor falls in a difference cover modulo PERIOD have ranks, worked out
beforehand for the block, and tied suffixes compare the ranks at the first such position both have. What differs in rank only
beyond LENGTH bytes is told apart by one look at the neighbours in the order.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import hashing
from tessera.session import cut

LENGTH = 100  # bytes of a repeated string
ANCHOR = 36
PREFIX = 32
# A perfect difference set; every residue is a difference of two of them.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
CHUNK = 1 << 20  # bytes of text hashed at once
BLOCK = 1 << 20  # bytes of pieces sorted at once
BUCKET_BYTES = 8 << 20  # text per bucket
# An anchor with more occurrences is dealt out suffix by suffix, so that its bucket stays small.
HEAVY = 100_000
LOW = np.uint64((1 << 24) - 1)


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring suffixes with one anchor: (first, end, anchor, text number, anchor's hash).

    ``data`` must be shorter than 16 MB.
    """
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, none.astype(np.uint64)
    starts = np.arange(len(data) - ANCHOR + 1)
    full = hashing.Prefix(data).hashes(starts, starts + ANCHOR)
    least = (full & ~LOW) | starts.astype(np.uint64)
    span, width = LENGTH - ANCHOR + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[:width - span], least[span - width:])
    anchor = (least & LOW).astype(np.int64)
    start = np.arange(len(anchor))
    text = np.searchsorted(offsets, start, "right") - 1
    whole = start + LENGTH <= offsets[text + 1]
    start, anchor, text = start[whole], anchor[whole], text[whole]
    if not len(start):
        return none, none, none, none, none.astype(np.uint64)
    edge = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]), [True]]))
    first = start[edge[:-1]]
    return first, start[edge[1:] - 1] + 1, anchor[edge[:-1]], text[edge[:-1]], full[anchor[edge[:-1]]]


def _chunks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, list[int], int]]:
    """(bytes, offsets, text numbers, bytes of the text before) of texts, about CHUNK bytes at once; a long text comes in parts that overlap."""
    held, numbers, size = [], [], 0
    for number, text in enumerate(texts):
        if len(text) < LENGTH:
            continue
        if held and size + len(text) > CHUNK:
            yield np.frombuffer(b"".join(held), np.uint8), np.cumsum([0] + [len(t) for t in held]), numbers, 0
            held, numbers, size = [], [], 0
        if len(text) > 2 * CHUNK:
            for at in range(0, len(text) - LENGTH + 1, CHUNK):
                part = text[at:at + CHUNK + LENGTH - 1]
                yield np.frombuffer(part, np.uint8), np.array([0, len(part)]), [number], at
            continue
        held.append(text)
        numbers.append(number)
        size += len(text)
    if held:
        yield np.frombuffer(b"".join(held), np.uint8), np.cumsum([0] + [len(t) for t in held]), numbers, 0


def _pack(*arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, *arrays)
    return zstandard.compress(out.getvalue())


def _unpack(blob: bytes) -> list[np.ndarray]:
    with np.load(io.BytesIO(zstandard.decompress(blob))) as held:
        return [held[name] for name in held.files]


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes, with their size and digest."""
    for batch in batches:
        at = batch.schema.get_field_index("__text")
        bodies = [(t.as_py() or "").encode() for t in batch.column(at)]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(i) for i in range(batch.num_columns) if i != at], pa.array([zstandard.compress(b) for b in bodies], pa.binary()),
             pa.array([len(b) for b in bodies], pa.int64()), pa.array([hashlib.sha256(b).hexdigest() for b in bodies])],
            names=[*[n for n in batch.schema.names if n != "__text"], "body", "n_bytes", "digest"])


PARTS = pa.schema([("bucket", pa.int32()), ("known", pa.bool_()), ("blob", pa.binary())])
PARTS_SQL = "bucket int, known boolean, blob binary"


def _dealt(bucket: np.ndarray, known: bool, *arrays: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, known, blob): the arrays cut by bucket."""
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) != 0, [True]])) if len(order) else [0]
    rows = [(int(bucket[order[a]]), known, _pack(*[x[order[a:b]] for x in arrays])) for a, b in zip(edges[:-1], edges[1:])]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), PARTS.types)], schema=PARTS)


def _count_anchors(buckets: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, uids, held = [], [], 0

        def flush():
            h, uid = np.concatenate(hashes), np.concatenate(uids)
            order = np.argsort(h, kind="stable")
            h, uid = h[order], uid[order]
            value, first, count = np.unique(h, return_index=True, return_counts=True)
            # what this task has twice is repeated for sure; one row stands for it elsewhere
            twice = np.repeat(count > 1, count)
            yield from _dealt((uid[twice] % buckets).astype(np.int32), True, h[twice], uid[twice])
            yield from _dealt((value % np.uint64(buckets)).astype(np.int32), False, value, uid[first], count)

        for batch in batches:
            own = batch.column(0).to_numpy()
            bodies = [zstandard.decompress(b.as_py()) for b in batch.column(1)]
            for data, offsets, numbers, _ in _chunks(bodies):
                _, _, _, text, h = anchors(data, offsets)
                hashes.append(h)
                uids.append(own[np.array(numbers)[text]])
                held += len(h)
            if held > 2_000_000:
                yield from flush()
                hashes, uids, held = [], [], 0
        if held:
            yield from flush()

    return work


def _repeated(table: pa.Table) -> pa.Table:
    """(uid, anchor) of repeated anchors of a bucket; uid is null for a heavy one."""
    uids, hashes = [], []
    single = []
    for known, blob in zip(table["known"].to_pylist(), table["blob"].to_pylist()):
        if known:
            h, uid = _unpack(blob)
            hashes.append(h)
            uids.append(uid)
        else:
            single.append(_unpack(blob))
    heavy = np.zeros(0, np.uint64)
    if single:
        h, uid, count = (np.concatenate(x) for x in zip(*single))
        value, group = np.unique(h, return_inverse=True)
        total = np.bincount(group, weights=count)
        hit = (total[group] > 1) & (count == 1)
        hashes.append(h[hit])
        uids.append(uid[hit])
        heavy = value[total > HEAVY]
    h, uid = np.concatenate([heavy, *hashes]), np.concatenate([np.zeros(len(heavy), np.int64), *uids])
    return pa.table({"uid": pa.array(uid, mask=np.arange(len(uid)) < len(heavy)), "anchor": h.view(np.int64)})


def _pieces(buckets: int):
    """Pieces of text around repeated anchors, dealt to buckets; what a task has twice is sent once."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int, bytes], list] = {}
        size = 0

        def flush():
            later = [(p[2], p[3], n) for places, n in ((sorted(v), len(k[2]) - LENGTH + 1) for k, v in held.items()) for p in places[1:]]
            if later:
                uid, start, n = (np.array(x, np.int64) for x in zip(*later))
                yield from _dealt((uid % buckets).astype(np.int32), True, uid, start, n)
            first = [(k[0], k[1], *min(v), k[2]) for k, v in held.items()]
            if first:
                h, rel, some, key, uid, start, text = zip(*first)
                h = np.array(h, np.uint64)
                bucket = (h % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                for a, b in zip(*(lambda e: (e[:-1], e[1:]))(np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) != 0, [True]])))):
                    own = order[a:b]
                    blob = _pack(h[own], *[np.array([x[i] for i in own], np.int64) for x in (rel, some, key, uid, start)], np.array([len(text[i]) for i in own]),
                                 np.frombuffer(b"".join(text[i] for i in own), np.uint8))
                    yield pa.RecordBatch.from_arrays([pa.array([int(bucket[own[0]])], pa.int32()), pa.array([False]), pa.array([blob], pa.binary())], schema=PARTS)

        for batch in batches:
            uid, key, body, wanted, heavy = (batch.column(batch.schema.get_field_index(n)) for n in ("uid", "key", "body", "wanted", "heavy"))
            bodies = [zstandard.decompress(b.as_py()) for b in body]
            for data, offsets, numbers, before in _chunks(bodies):
                first, end, anchor, text, h = anchors(data, offsets)
                raw = data.tobytes()
                bounds = np.searchsorted(text, np.arange(len(numbers) + 1))
                for t, number in enumerate(numbers):
                    own = slice(bounds[t], bounds[t + 1])
                    want = wanted[number].values.to_numpy().view(np.uint64)
                    big = set(heavy[number].values.to_numpy().view(np.uint64).tolist())
                    # a null key comes first
                    place = (int(key[number].is_valid), key[number].as_py() or 0, uid[number].as_py())
                    base = before - int(offsets[t])
                    hits = np.flatnonzero(np.isin(h[own], want)) + bounds[t]
                    for a, b, x, value in zip(*(c[hits].tolist() for c in (first, end, anchor, h))):
                        if value in big:
                            for p in range(a, b):
                                piece = raw[p:p + LENGTH]
                                alone = int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "little")
                                held.setdefault((alone, x - p, piece), []).append((*place, p + base))
                                size += LENGTH
                        else:
                            piece = raw[a:b + LENGTH - 1]
                            held.setdefault((value, x - a, piece), []).append((*place, a + base))
                            size += len(piece)
                if size > 16 << 20:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    return work


def later_suffixes(text: np.ndarray, starts: np.ndarray, sizes: np.ndarray, anchor: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Positions in ``text`` of suffixes that are equal, in LENGTH bytes, to one further left.

    ``text`` are pieces one after the other, in document order within a group; ``anchor`` is the anchor's place in its piece. Suffixes
    are compared within a group, which equal ones share, as they share their distance from the anchor.
    """
    many = np.maximum(0, sizes - LENGTH + 1)
    piece = np.repeat(np.arange(len(starts)), many)
    within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    at = starts[piece] + within
    if not len(at):
        return at
    padded = np.concatenate([text, np.zeros(LENGTH + 16, np.uint8)])
    word = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)).view(">u8").ravel().astype(np.uint64)
    lane = group[piece].astype(np.int64) * 4 * LENGTH + (within - anchor[piece] + 2 * LENGTH)  # group, and distance from the anchor
    keys = [word[at + j] for j in range(PREFIX - 8, -1, -8)]
    order = np.lexsort([*keys, lane])
    same = np.ones(len(order) - 1, bool)
    for k in (*keys, lane):
        same &= k[order[1:]] == k[order[:-1]]
    tie = np.cumsum(np.concatenate([[0], ~same]))
    tied = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    order, tie = order[tied], tie[tied]
    if not len(order):
        return order
    # long ties: ranks of the cover positions that tied suffixes reach first
    to_cover = np.array([next(k for k in range(PERIOD) if (r + k) % PERIOD in COVER) for r in range(PERIOD)])
    sample = at[order] + to_cover[(within[order] - anchor[piece[order]]) % PERIOD]
    places, which = np.unique(sample, return_inverse=True)
    columns = [word[places + j] for j in range(LENGTH - 4, -1, -8)]
    by_rank = np.lexsort(columns)
    new = np.zeros(len(places) - 1, bool)
    for c in columns:
        new |= c[by_rank[1:]] != c[by_rank[:-1]]
    rank = np.empty(len(places), np.int64)
    rank[by_rank] = np.concatenate([[0], np.cumsum(new)])
    own = rank[which]
    again = np.lexsort([own, tie])
    p, own, tie = at[order][again], own[again], tie[again]
    # neighbours that tie but differ in rank may do so only beyond LENGTH bytes
    edge = np.concatenate([[True], (tie[1:] != tie[:-1]) | (own[1:] != own[:-1])])
    look = np.flatnonzero(edge[1:] & (tie[1:] == tie[:-1])) + 1
    equal = np.ones(len(look), bool)
    for j in (*range(PREFIX, LENGTH - 8, 8), LENGTH - 8):
        equal &= word[p[look] + j] == word[p[look - 1] + j]
    edge[look[equal]] = False
    heads = np.flatnonzero(edge)
    leftmost = np.minimum.reduceat(p, heads)
    return np.sort(p[p != np.repeat(leftmost, np.diff(np.append(heads, len(p))))])


def _sorted_bucket(table: pa.Table) -> pa.Table:
    """(uid, start, n): runs of later suffixes of a bucket."""
    out, held = [], []
    for known, blob in zip(table["known"].to_pylist(), table["blob"].to_pylist()):
        (out if known else held).append(tuple(_unpack(blob)))
    if held:
        h, rel, some, key, uid, start, size, text = (np.concatenate(x) for x in zip(*held))
        held.clear()
        offset = np.cumsum(size) - size
        order = np.lexsort([start, uid, key, some, h])
        group = np.cumsum(np.concatenate([[0], np.diff(h[order].view(np.int64)) != 0]))
        total = np.cumsum(size[order])
        a = 0
        while a < len(order):
            # whole groups, about BLOCK bytes
            b = int(np.searchsorted(total, (total[a - 1] if a else 0) + BLOCK, "right"))
            b = int(np.searchsorted(group, group[min(b, len(order) - 1)], "left")) if b < len(order) else b
            b = b if b > a else int(np.searchsorted(group, group[a], "right"))
            own = order[a:b]
            sizes = size[own]
            places = np.cumsum(sizes) - sizes
            block = text[np.repeat(offset[own], sizes) + np.arange(sizes.sum()) - np.repeat(places, sizes)]
            p = later_suffixes(block, places, sizes, rel[own], group[a:b] - group[a])
            piece = np.searchsorted(places, p, "right") - 1
            head = np.flatnonzero(np.concatenate([[True], (np.diff(p) != 1) | (np.diff(piece) != 0)])) if len(p) else np.zeros(0, np.int64)
            who = own[piece[head]]
            out.append((uid[who], start[who] + p[head] - places[piece[head]], np.diff(np.append(head, len(p)))))
            a = b
    columns = [np.concatenate(x).astype(np.int64) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
    return pa.table(dict(zip(("uid", "start", "n"), columns)))


def merged(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs (start, end) of the bytes under runs of ``counts`` suffixes."""
    order = np.argsort(starts, kind="stable")
    a = starts[order]
    b = np.maximum.accumulate(a + counts[order] + LENGTH - 1)
    head = np.flatnonzero(np.concatenate([[True], a[1:] > b[:-1]]))
    return a[head], b[np.append(head[1:], len(a)) - 1]


def _finished(with_kept: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, body, size, digest, starts, counts = (batch.column(batch.schema.get_field_index(n)) for n in ("key", "body", "n_bytes", "digest", "starts", "counts"))
            removed, spans, shas, kept = [], [], [], []
            for i in range(batch.num_rows):
                if not starts[i].is_valid:
                    removed.append(0)
                    spans.append(0)
                    shas.append(digest[i].as_py())
                    kept.append(zstandard.decompress(body[i].as_py()) if with_kept else None)
                    continue
                text = zstandard.decompress(body[i].as_py())
                a, b = merged(starts[i].values.to_numpy(), counts[i].values.to_numpy())
                rest = b"".join(text[x:y] for x, y in zip(np.append(0, b), np.append(a, len(text))))
                removed.append(len(text) - len(rest))
                spans.append(len(a))
                shas.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest if with_kept else None)
            arrays = [key, size, pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(shas, pa.string())]
            names = ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_kept:
                arrays, names = [*arrays, pa.array(kept, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return work


def dedup_substrings(docs: DataFrame, key: str = "doc_id", text: str = "text", with_kept: bool = False) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, and kept) of every document.

    Every byte that a 100-byte string covers which also starts earlier is removed: in a document of a smaller key, or further left in
    the same one. Strings are judged on the input, overlaps count, and no string reaches over two documents. ``key`` is an
    integer. A null key comes first; rows of equal keys are different documents, in the order they are read. A null text is empty; texts
    under 100 bytes lose nothing. ``kept`` are the remaining bytes; a cut may go through a character.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.monotonically_increasing_id().alias("uid"), F.col(text).alias("__text"))
    base = cut(rows.mapInArrow(_stored, "key bigint, uid bigint, body binary, n_bytes bigint, digest string"))
    total = base.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(12, -(-total // BUCKET_BYTES))
    found = base.where(F.col("n_bytes") >= LENGTH)
    counted = found.select("uid", "body").mapInArrow(_count_anchors(buckets), PARTS_SQL)
    repeated = cut(counted.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_repeated, "uid bigint, anchor bigint"))
    heavy = repeated.where("uid is null").select("anchor", F.lit(True).alias("is_heavy"))
    wanted = repeated.where("uid is not null").join(heavy, "anchor", "left")
    wanted = wanted.groupBy("uid").agg(F.collect_set("anchor").alias("wanted"), F.collect_set(F.when(F.col("is_heavy"), F.col("anchor"))).alias("heavy"))
    # the hints keep the plan the same at every size
    pieces = found.select("uid", "key", "body").join(wanted.hint("merge"), "uid").mapInArrow(_pieces(buckets), PARTS_SQL)
    # a task per bucket, however many there are: tasks do not grow with the input
    later = pieces.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_sorted_bucket, "uid bigint, start bigint, n bigint")
    # the two lists of a document stay aligned, as one list of pairs
    spans = later.groupBy("uid").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    spans = spans.select("uid", F.col("runs.start").alias("starts"), F.col("runs.n").alias("counts"))
    joined = base.join(cut(spans).hint("merge"), "uid", "left").select("key", "body", "n_bytes", "digest", "starts", "counts")
    made = joined.mapInArrow(_finished(with_kept), "key bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * with_kept)
    return made.withColumnRenamed("key", key)

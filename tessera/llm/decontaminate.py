"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

The n-grams of the test items are counted over all documents. Of every few neighbouring n-grams of an item the rarest is
a seed, so an item has seeds all along, however common its words are. Wherever a seed stands in a document, the passage
around it is aligned with the item; copies with changed, missing or added words still score high.

Test items are taken in blocks of bounded size, which travel with the tasks; documents are mapped where they lie and
never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import hashing

N = 3  # words of a seed
SPACING = 3  # one seed among so many neighbouring n-grams
CHUNK = 256  # longer items are compared in even chunks of at most so many words
BLOCK_BYTES = 8 << 20  # test items per pass
MATCH, MISMATCH, GAP = 2, -1, -1
SHARE = 0.5  # of the score of a perfect copy
LEAST_WORDS = 8  # that must match at least, or the whole item if it is shorter
BATCH = 256  # alignments at once
APART = hashing.separators(r"[^0-9A-Za-z]")
PLACE = np.random.default_rng(13).integers(0, 1 << 63, N, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every word."""
    starts, ends, text = hashing.words(data, offsets, APART)
    return (hashing.Prefix(data, hashing.FOLDED).hashes(starts, ends) if len(starts) else np.zeros(0, np.uint64)), text


def grams(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of every n-gram that lies in one text."""
    count = max(0, len(words) - N + 1)
    at = np.flatnonzero(text[:count] == text[len(text) - count:]) if count else np.zeros(0, np.int64)
    h = np.zeros(len(at), np.uint64)
    for j in range(N):
        h += words[at + j] * PLACE[j]
    return hashing.mix(h), at


@dataclass
class Items:
    """A block of test items, cut into chunks."""

    ids: list
    words: list[np.ndarray]  # per chunk
    owner: np.ndarray  # item of each chunk
    kind: pa.DataType  # of the ids

    @classmethod
    def of(cls, table: pa.Table) -> Items:
        ids, words, owner = [], [], []
        for row in table.to_pylist():
            data = np.frombuffer((row["text"] or "").encode(), np.uint8)
            h, _ = word_hashes(data, np.array([0, len(data)]))
            # chunks of even sizes: none is a short rest that common words would match
            for part in np.array_split(h, -(-len(h) // CHUNK)) if len(h) else ():
                words.append(part)
                owner.append(len(ids))
            ids.append(row["item"])
        return cls(ids, words, np.array(owner, np.int64), table.schema.field("item").type)

    def grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, chunk, place) of all n-grams of the chunks."""
        parts = [grams(w, np.zeros(len(w), np.int64)) for w in self.words]
        return (np.concatenate([h for h, _ in parts] or [np.zeros(0, np.uint64)]), np.repeat(np.arange(len(parts)), [len(h) for h, _ in parts]),
                np.concatenate([a for _, a in parts] or [np.zeros(0, np.int64)]))


def rare_seeds(h: np.ndarray, chunk: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which n-grams are the rarest (the first of equals) among some SPACING neighbours."""
    chosen = np.zeros(len(h), bool)
    for c in np.unique(chunk):
        own = np.flatnonzero(chunk == c)
        for start in range(max(1, len(own) - SPACING + 1)):
            some = own[start:start + SPACING]
            chosen[some[counts[some].argmin()]] = True
    return chosen


def align(items: np.ndarray, item_sizes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignments: score, last item word and last document word of each pair.

    ``items`` (pairs x words) and ``docs`` (pairs x words) are padded with numbers that match nothing.
    """
    pairs, width = docs.shape
    slope = -GAP * np.arange(width)
    above = np.zeros((pairs, width + 1), np.int32)
    best, item_at, doc_at = np.zeros(pairs, np.int32), np.zeros(pairs, np.int64), np.zeros(pairs, np.int64)
    for i in range(items.shape[1]):
        step = above[:, :-1] + np.where(docs == items[:, i, None], MATCH, MISMATCH).astype(np.int32)
        step = np.maximum(np.maximum(step, above[:, 1:] + GAP), 0)
        # a gap in the item: the best cell to the left, less its distance
        step = np.maximum.accumulate(step + slope, axis=1) - slope
        top = step.argmax(axis=1)
        score = np.where(i < item_sizes, step[np.arange(pairs), top], 0)
        better = score > best
        best[better], item_at[better], doc_at[better] = score[better], i, top[better]
        above[:, 1:] = step
    return best, item_at, doc_at


class Matcher:
    """Finds the items of a block in texts."""

    def __init__(self, items: Items, counts: np.ndarray, share: float):
        self.items, self.share = items, share
        h, chunk, place = items.grams()
        seed = rare_seeds(h, chunk, counts)
        order = np.argsort(h[seed], kind="stable")
        self.hash, self.chunk, self.place = h[seed][order], chunk[seed][order], place[seed][order]

    def find(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, float, int, int]]:
        """(text, item, score, first word, last word) of every leak: the best place per text and item."""
        words, text = word_hashes(data, offsets)
        h, at = grams(words, text)
        low, high = np.searchsorted(self.hash, h, "left"), np.searchsorted(self.hash, h, "right")
        hits = np.flatnonzero(high > low)
        if not len(hits):
            return []
        times = (high - low)[hits]
        seed = np.repeat(low[hits], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        where, chunk = np.repeat(at[hits], times), self.chunk[seed]
        sizes = np.array([len(w) for w in self.items.words])
        slack = np.maximum(8, sizes[chunk] // 4)
        # neighbouring diagonals share a window
        lane = (where - self.place[seed]) // slack
        keys = np.unique(np.stack([text[where], chunk, lane], axis=1), axis=0)
        first = np.searchsorted(text, np.arange(len(offsets)))
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        for start in range(0, len(keys), BATCH):
            t, c, k = keys[start:start + BATCH].T
            n = sizes[c]
            slack = np.maximum(8, n // 4)
            a = np.maximum(first[t], (k - 1) * slack)
            b = np.minimum(first[t + 1], (k + 2) * slack + n)
            docs = np.full((len(t), int((b - a).max())), 1, np.uint64)
            own = np.full((len(t), int(n.max())), 2, np.uint64)
            for i in range(len(t)):
                docs[i, :b[i] - a[i]] = words[a[i]:b[i]]
                own[i, :n[i]] = self.items.words[c[i]]
            score, item_end, doc_end = align(own, n, docs)
            share = score / (MATCH * n)
            need = np.maximum(self.share, np.minimum(LEAST_WORDS, n) / n)
            for i in np.flatnonzero(share >= need - 1e-9):
                # the same alignment backwards tells where it starts
                back_doc, back_item = docs[i, :doc_end[i] + 1][::-1][None], own[i, :item_end[i] + 1][::-1][None]
                _, _, length = align(back_item, np.array([item_end[i] + 1]), back_doc)
                last = int(a[i] - first[t[i]] + doc_end[i])
                found = (float(share[i]), last - int(length[0]), last)
                key = (int(t[i]), int(self.items.owner[c[i]]))
                if key not in best or (-found[0], found[1]) < (-best[key][0], best[key][1]):
                    best[key] = found
        return [(t, i, *v) for (t, i), v in sorted(best.items())]


def _matchers(docs: DataFrame, benchmark: DataFrame, item: str, text: str, share: float) -> Iterator[Matcher]:
    """A matcher per block of test items, with the counts of its n-grams over all documents."""
    tests = benchmark.select(F.col(item).alias("item"), F.lower(F.col(text)).alias("text")).where("text is not null")
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES)) if size else 0
    for b in range(blocks):
        block = Items.of(tests.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).orderBy("item", "text").toArrow())
        h, _, _ = block.grams()
        known = np.unique(h)

        def count(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(known), np.int64)
            for batch in batches:
                for _, _, data, offsets in hashing.text_slices(batch.column(0)):
                    seen, _ = grams(*word_hashes(data, offsets))
                    place = np.searchsorted(known, seen)
                    place[place == len(known)] = 0
                    total += np.bincount(place[known[place] == seen], minlength=len(known)) if len(known) else 0
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"gram": some, "n": total[some]})

        counts = np.zeros(len(known), np.int64)
        rows = docs.select(F.lower(F.col("text"))).mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
        counts[rows["gram"].to_numpy()] = rows["n"].to_numpy()
        yield Matcher(block, counts[np.searchsorted(known, h)], share)


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id", share: float = SHARE) -> DataFrame:
    """(key, item, score, first_word, last_word) of every document that holds a test item, or a worked-over copy of one.

    Both tables have a ``text``; other columns are ignored. The score is that of the best local alignment, over that of a perfect copy: 2 for an equal
    word, -1 for a changed, missing or added one. A leak has at least ``share`` and LEAST_WORDS equal words' worth (all words of a
    shorter item). Words are lower-case runs of letters and digits. Items of more than CHUNK words count by their best
    chunk. Null and empty texts, and items of fewer than N words, are in no leak. Repeated documents or items give
    repeated rows; of equal alignments the first place is reported. Without items or documents there are no rows.
    """
    schema = docs.select(F.col(key)).schema.add("item", benchmark.schema[item].dataType).add("score", "double").add("first_word", "long").add("last_word", "long")
    found = docs.sparkSession.createDataFrame([], schema)
    for matcher in _matchers(docs, benchmark, item, "text", share):
        def work(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start, _, data, offsets in hashing.text_slices(batch.column(1)):
                    leaks = matcher.find(data, offsets)
                    if leaks:
                        row, number, score, first, last = zip(*leaks)
                        ids = [matcher.items.ids[i] for i in number]
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([start + r for r in row])), pa.array(ids, matcher.items.kind), pa.array(score), pa.array(first, pa.int64()),
                                                          pa.array(last, pa.int64())], names=[key, "item", "score", "first_word", "last_word"])

        found = found.unionByName(docs.select(F.col(key), F.lower(F.col("text"))).mapInArrow(work, schema))
    return found.withColumnRenamed("item", item)


def without_leaks(docs: DataFrame, benchmark: DataFrame, item: str = "item_id", share: float = SHARE) -> DataFrame:
    """``docs`` without the documents that ``find_leaks`` reports. All columns are kept, null texts too."""
    kept = docs
    for matcher in _matchers(docs, benchmark, item, "text", share):
        def work(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for start, _, data, offsets in hashing.text_slices(batch.column(batch.num_columns - 1)):
                    clean[[start + t for t, *_ in matcher.find(data, offsets)]] = False
                yield batch.filter(pa.array(clean)).drop_columns(["__lower"])

        kept = kept.withColumn("__lower", F.lower(F.col("text"))).mapInArrow(work, docs.schema)
    return kept

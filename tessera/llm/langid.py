"""Language ID by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram is its three letter vectors, rotated by their place in it
and multiplied (*bound*); a text, or all texts of a language, is the sum of its trigrams (*bundled*). A text speaks
the language whose bundle has the largest cosine with its own.

Training sends one bundle per task and language through the shuffle, whatever the size of the corpus. Prediction is
a map over the documents with the bundles of all languages at hand.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIM = 1024  # elements of a vector
SEED = 20_241
# Bundles of all languages travel with the tasks: 8 KB for each. More labels than this are no languages.
MAX_LANGUAGES = 2_000
CHARS, ROWS = 1 << 19, 256  # texts taken at once, to bound memory
UNKNOWN = "und"


@lru_cache(maxsize=65_536)
def letter_vector(code: int) -> np.ndarray:
    """The letter's vector; it depends on the letter only, so all tasks and runs agree. 0 is the edge of a word."""
    return np.random.default_rng((SEED, code)).integers(0, 2, DIM, dtype=np.int8) * np.int8(2) - np.int8(1)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Counts (texts x trigrams, float32) and the trigrams' letters (trigrams x 3).

    Texts are lower-cased; whatever is no letter is the edge of a word. A trigram has a letter in its middle, so none
    reaches over two words or texts.
    """
    folded = [t.lower() for t in texts]
    codes = np.frombuffer(("\n" + "\n".join(folded) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    text_of = np.repeat(np.arange(len(folded)), [len(t) + 1 for t in folded])
    codes = np.where(_letters()[codes], codes, 0)
    middle = np.flatnonzero(codes)
    if not len(middle):
        return np.zeros((len(texts), 0), np.float32), np.zeros((0, 3), np.int64)
    seen = np.zeros(0x110000, bool)
    seen[codes] = True
    letters = np.flatnonzero(seen)
    number = np.zeros(0x110000, np.int64)
    number[letters] = np.arange(len(letters))
    small, n = number[codes], len(letters)
    ids = (small[middle - 1] * n + small[middle]) * n + small[middle + 1]
    if n ** 3 <= 1 << 22:
        used = np.zeros(n ** 3, bool)
        used[ids] = True
        trigrams = np.flatnonzero(used)
        place = np.zeros(n ** 3, np.int64)
        place[trigrams] = np.arange(len(trigrams))
        columns = place[ids]
    else:
        trigrams, columns = np.unique(ids, return_inverse=True)
    width = len(trigrams)
    # the edge before text 0 makes every text start one place later
    cells = text_of[middle - 1] * width + columns
    counts = np.bincount(cells, minlength=len(texts) * width).reshape(len(texts), width).astype(np.float32)
    return counts, np.stack([letters[trigrams // (n * n)], letters[trigrams // n % n], letters[trigrams % n]], axis=1)


def trigram_vectors(letters: np.ndarray) -> np.ndarray:
    """Bound vectors (trigrams x DIM): first letter rotated twice, second once, third not."""
    known, place = np.unique(letters, return_inverse=True)
    plain = np.stack([letter_vector(int(c)) for c in known])
    place = place.reshape(letters.shape)
    return (np.roll(plain, 2, axis=1)[place[:, 0]] * np.roll(plain, 1, axis=1)[place[:, 1]] * plain[place[:, 2]]).astype(np.float32)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of at most ROWS rows and about CHARS characters (one long text may be more)."""
    for batch in batches:
        sizes = np.cumsum([len(t) if t else 0 for t in batch.column("__text").to_pylist()] or [0])
        start = 0
        while start < batch.num_rows:
            base = sizes[start - 1] if start else 0
            end = min(start + ROWS, max(start + 1, int(np.searchsorted(sizes, base + CHARS, "right"))), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def _bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for part in _groups(batches):
        langs = np.array(part.column("__lang").to_pylist(), object)
        counts, letters = trigram_counts([t or "" for t in part.column("__text").to_pylist()])
        if not len(letters):
            continue
        vectors = trigram_vectors(letters)
        for lang in sorted(set(langs)):
            total = counts[langs == lang].sum(axis=0, dtype=np.float64) @ vectors
            sums[lang] = sums[lang] + total if lang in sums else total
    if sums:
        yield pa.RecordBatch.from_pydict({"lang": list(sums), "bundle": [v.tolist() for v in sums.values()]},
                                         schema=pa.schema([("lang", pa.string()), ("bundle", pa.list_(pa.float64()))]))


@dataclass(frozen=True)
class Profiles:
    """Bundles of the known languages, in order of their names."""

    langs: tuple[str, ...]
    bundles: np.ndarray


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Profiles:
    """Bundle all texts of each non-null language. Rows without text or letters add nothing."""
    rows = docs.select(F.col(text).alias("__text"), F.col(lang).alias("__lang")).where("__text is not null and __lang is not null")
    sums = (rows.mapInArrow(_bundle, "lang string, bundle array<double>")
            .select("lang", F.posexplode("bundle").alias("at", "value")).groupBy("lang", "at").agg(F.sum("value").alias("value"))
            .groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]).alias("bundle"))
            .orderBy("lang").limit(MAX_LANGUAGES + 1).toArrow())
    if sums.num_rows > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} distinct values of {lang}: these are no languages")
    return Profiles(tuple(sums["lang"].to_pylist()), np.array(sums["bundle"].to_pylist(), np.float64).reshape(-1, DIM))


def predict(docs: DataFrame, profiles: Profiles, keep: list[Column | str], text: str = "text") -> DataFrame:
    """Columns ``keep``, then lang_pred and score (the cosine, negative ones as 0).

    A null text, or one without a letter, is ``und`` with score 0, and so is every text if nothing was learned.
    Equal cosines go to the name that sorts first. Whole texts are read, of any length; repeated rows get equal
    results.
    """
    langs = list(profiles.langs)
    norms = np.sqrt((profiles.bundles ** 2).sum(axis=1, keepdims=True))
    unit = profiles.bundles / np.where(norms == 0, 1, norms)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _groups(batches):
            names, scores = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
            if langs:
                counts, letters = trigram_counts([t or "" for t in part.column("__text").to_pylist()])
                if len(letters):
                    bundles = (counts @ trigram_vectors(letters)).astype(np.float64)
                    size = np.sqrt((bundles ** 2).sum(axis=1))
                    cosines = bundles @ unit.T / np.where(size == 0, 1, size)[:, None]
                    best = cosines.argmax(axis=1)
                    for i in np.flatnonzero(counts.any(axis=1)):
                        names[i], scores[i] = langs[best[i]], min(1.0, max(0.0, cosines[i, best[i]]))
            columns = [part.column(i) for i, n in enumerate(part.schema.names) if n != "__text"]
            names_of = [n for n in part.schema.names if n != "__text"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(scores)], names=[*names_of, "lang_pred", "score"])

    rows = docs.select(*keep, F.col(text).alias("__text"))
    schema = rows.drop("__text").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return rows.mapInArrow(work, schema)


def fold(key: str = "doc_id") -> Column:
    """crc32 of the key as text, modulo 4; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learned from the rows that are not held out.

    Fold 2 is held out. A row with a null doc_id has no fold: it is not learned from and counts as not held out.
    """
    profiles = train(docs.where(fold() != 2))
    return predict(docs, profiles, [F.col("doc_id"), F.coalesce(fold() == 2, F.lit(False)).alias("held_out")])

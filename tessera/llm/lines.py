"""Line deduplication by overlapping windows of three lines.

Every three consecutive lines of a document are a window. Windows are hashed, repeated ones are found over all
documents, and each line that a later occurrence covers is removed. The first occurrence stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import hashing
from tessera.session import cut

WINDOW = 3
BREAK = hashing.separators(r"\n")
SPACE = hashing.separators(r"[\x09-\x0D\x20]")
MIXERS = np.random.default_rng(5).integers(0, 1 << 63, (2, 16), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def text_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text number) of the lines that are not blank, without the white space around them."""
    solid = np.flatnonzero(~SPACE[data])
    starts, ends, text = hashing.words(data, offsets, BREAK)
    first, last = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    some = first < last
    return solid[first[some]], solid[last[some] - 1] + 1, text[some]


def _windows(size: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("__text")
            for start, end, data, offsets in hashing.text_slices(batch.column(at)):
                a, b, text = text_lines(data, offsets)
                line = hashing.Prefix(data).hashes(a, b) if len(a) else np.zeros(0, np.uint64)
                count = max(0, len(line) - size + 1)
                whole = np.flatnonzero(text[:count] == text[len(text) - count:]) if count else np.zeros(0, np.int64)
                both = []
                for row in MIXERS:
                    h = np.zeros(len(whole), np.uint64)
                    for j in range(size):
                        h += line[whole + j] * row[j]
                    both.append(hashing.mix(h).view(np.int64))
                bounds = pa.array(np.searchsorted(text[whole], np.arange(end - start + 1)).astype(np.int32))
                part = batch.slice(start, end - start)
                counts = np.bincount(text, minlength=end - start).astype(np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(counts), *[pa.ListArray.from_arrays(bounds, pa.array(h)) for h in both]],
                                                 names=[*part.schema.names, "__lines", "__h1", "__h2"])

    return work


def without_lines(text: str, covered: list[int]) -> tuple[str, int]:
    """The text without the given ones of its lines that are not blank, and how many runs of them there were.

    Blank lines do not count and stay.
    """
    gone, number, kept = set(covered), -1, []
    for line in text.split("\n"):
        if line.strip(" \t\r\x0b\x0c"):
            number += 1
            if number in gone:
                continue
        kept.append(line)
    return "\n".join(kept), sum(1 for i in gone if i - 1 not in gone)


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, hit = batch.schema.get_field_index("__text"), batch.schema.get_field_index("__covered")
        texts, removed, spans = [], [], []
        for text, covered in zip(batch.column(at), batch.column(hit)):
            text, covered = text.as_py(), covered.as_py()
            runs = 0
            if covered:
                text, runs = without_lines(text, covered)
            texts.append(text)
            removed.append(len(covered or ()))
            spans.append(runs)
        kept = [i for i in range(batch.num_columns) if i not in (at, hit)]
        yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], pa.array(texts, pa.string()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())],
                                         names=[*[batch.schema.names[i] for i in kept], "__text", "n_removed", "n_spans"])


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with ``text`` cleaned and n_lines, n_removed and n_spans added (columns of these names are replaced).

    Lines are compared without the white space around them; blank lines are skipped, and stay. Occurrences go by
    (key, place of the row, line); a null key comes first. All but the first occurrence of a window are removed, also where they
    overlap each other or the first. Rows with equal keys are different documents, in the order they are read. Texts with
    fewer lines than a window, empty ones and nulls stay as they are; n_lines counts lines that are not blank.
    """
    plain = [c for c in docs.columns if c not in ("n_lines", "n_removed", "n_spans", text)]
    rows = docs.select(*plain, F.col(key).alias("__key"), F.col(text).alias("__text"), F.monotonically_increasing_id().alias("__uid"))
    long = F.array(F.lit(0).cast("long"))
    base = cut(rows.mapInArrow(_windows(window), rows.withColumns({"__lines": F.lit(0).cast("long"), "__h1": long, "__h2": long}).schema))
    found = base.select("__uid", "__key", F.posexplode(F.arrays_zip("__h1", "__h2")).alias("at", "h")).select("__uid", "__key", "at", "h.*")
    # one row per window and task is shuffled
    first = found.groupBy("__h1", "__h2").agg(F.count("*").alias("n"), F.min(F.struct("__key", "__uid", "at")).alias("first"))
    first = cut(first.where("n > 1").select("__h1", "__h2", F.col("first.__uid").alias("first_uid"), F.col("first.at").alias("first_at")))
    later = cut(found.select("__uid", "at", "__h1", "__h2").join(first, ["__h1", "__h2"]).where("__uid <> first_uid or at <> first_at").select("__uid", "at"))
    covered = later.groupBy("__uid").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.sequence("at", F.col("at") + (window - 1)))))).alias("__covered"))
    # the same plan at every size
    joined = base.drop("__h1", "__h2", "__key").join(covered.hint("merge"), "__uid", "left").select(*plain, F.col("__lines").alias("n_lines"), "__text", "__covered")
    schema = joined.select(*plain, "n_lines", "__text", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans")).schema
    order = [c if c != text else "__text" for c in docs.columns if c not in ("n_lines", "n_removed", "n_spans")]
    return joined.mapInArrow(_removed, schema).select(*order, "n_lines", "n_removed", "n_spans").withColumnRenamed("__text", text)

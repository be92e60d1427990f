"""Term frequencies of nodes, the occurrences of a term brought together per task before anything is shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from tessera.session import cut

GROUP_WORDS = 1 << 21  # words of neighbouring nodes that are counted together
ROWS = 1 << 14  # terms handed on at once


def _grouped(table: pa.Table, keys: list[str], words: str) -> Iterator[pa.RecordBatch]:
    lists = table.column(words).combine_chunks()
    flat, row = pc.list_flatten(lists), pc.list_parent_indices(lists)
    known = pc.is_valid(flat)
    coded, row = flat.filter(known).dictionary_encode(), row.filter(known).to_numpy().astype(np.int64)
    if not len(row):
        return
    width = max(table.num_rows, 1)
    pair, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * width + row, return_counts=True)
    code, row = pair // width, pa.array(pair % width)
    first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
    ends = np.append(first, len(code))
    found = pa.StructArray.from_arrays([*(table.column(k).take(row).combine_chunks() for k in keys), pa.array(tf.astype(np.int64))], [*keys, "tf"])
    made = pa.RecordBatch.from_arrays(
        [coded.dictionary.take(pa.array(code[first])), pa.array(np.diff(ends)), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), found)],
        ["term", "n", "found"])
    for at in range(0, made.num_rows, ROWS):
        yield made.slice(at, ROWS)


def term_groups(nodes: DataFrame, keys: list[str], words: str = "words") -> DataFrame:
    """``term, n, found``: the ``n`` nodes of a group that hold the term, as ``found`` array<struct<keys, tf>>.

    A group is nodes that lie together in a task, about ``GROUP_WORDS`` words of them. A frequent term is a row per group and not per node, so a
    join by term moves each term a few times, and its document frequency is the sum of ``n``. Nodes are read once: the groups are a table.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += pc.sum(pc.list_value_length(batch.column(words))).as_py() or 0
            if size >= GROUP_WORDS:
                yield from _grouped(pa.Table.from_batches(held), keys, words)
                held, size = [], 0
        if held:
            yield from _grouped(pa.Table.from_batches(held), keys, words)

    entry = T.StructType([*(nodes.schema[k] for k in keys), T.StructField("tf", T.LongType())])
    schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("n", T.LongType()), T.StructField("found", T.ArrayType(entry))])
    return cut(nodes.select(*keys, words).mapInArrow(task, schema))


def idf_of(groups: DataFrame, nodes: DataFrame) -> DataFrame:
    """``term, idf`` with ``ln(N / df)``.

    The counted terms are dealt out once more: AQE splits a hot term of a join only where both sides come straight from a shuffle of the
    join, not from an aggregate on top of one.
    """
    n = nodes.agg(F.count("*").alias("n")).scalar()
    df = groups.groupBy("term").agg(F.sum("n").alias("df"))
    return df.select("term", F.log(n / F.col("df")).alias("idf")).hint("rebalance")


def terms_with_idf(groups: DataFrame, idf: DataFrame) -> DataFrame:
    """``keys, tf, term, idf``, a row per node and term."""
    return groups.join(idf, "term").select("term", "idf", F.inline("found"))

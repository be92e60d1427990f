"""Which documents hold which passages whole."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tessera.session import bounded_rows

MAX_PASSAGES = 20_000
TEXTS_PER_BLOCK = 2_000


def _matcher(ids: list, texts: list[str]):
    """Function text -> set of ids of the passages it contains; one pass over the text."""
    try:
        import ahocorasick
    except ImportError:
        return lambda text: {i for i, p in zip(ids, texts) if p in text}
    groups: dict[str, list] = {}
    for i, p in zip(ids, texts):
        groups.setdefault(p, []).append(i)
    automaton = ahocorasick.Automaton()
    for p, members in groups.items():
        if p:
            automaton.add_word(p, members)
    everywhere = groups.get("", [])
    if not len(automaton):
        return lambda text: set(everywhere)
    automaton.make_automaton()
    return lambda text: set(everywhere).union(*(members for _, members in automaton.iter(text)))


def holders(docs: DataFrame, passages: DataFrame, doc_key: str = "doc_id", text: str = "text",
            qid: str = "qid", passage: str = "text", max_passages: int = MAX_PASSAGES) -> DataFrame:
    """``qid, doc_id`` for every passage that occurs whole in a document.

    A bounded passage list travels with the tasks; a longer one meets blocks of documents by an
    equi-join on even block numbers.
    """
    docs = docs.select(doc_key, F.col(text).alias("text"))
    passages = passages.select(qid, F.col(passage).alias("passage"))
    schema = T.StructType([passages.schema[qid], docs.schema[doc_key]])
    packed = bounded_rows(passages, max_passages)
    if packed is not None:
        return docs.mapInArrow(_scan(packed, doc_key, qid), schema)

    doc_blocks = docs.count() // TEXTS_PER_BLOCK + 1
    passage_blocks = passages.count() // max_passages + 1
    left = (docs.withColumn("_db", F.pmod(F.xxhash64(doc_key), F.lit(doc_blocks)))
            .withColumn("_pb", F.explode(F.sequence(F.lit(0), F.lit(passage_blocks - 1)))))
    right = (passages.withColumn("_pb", F.pmod(F.xxhash64(qid), F.lit(passage_blocks)).cast("int"))
             .withColumn("_db", F.explode(F.sequence(F.lit(0), F.lit(doc_blocks - 1)).cast("array<bigint>"))))

    def meet(doc_block: pa.Table, passage_block: pa.Table) -> pa.Table:
        return _pairs(doc_block, passage_block[qid], _matcher_of(passage_block, qid), doc_key, qid)

    return left.groupBy("_db", "_pb").cogroup(right.groupBy("_db", "_pb")).applyInArrow(meet, schema)


def _matcher_of(passages: pa.Table, qid: str):
    return _matcher(passages[qid].to_pylist(), passages["passage"].to_pylist())


def _scan(packed: pa.Table, doc_key: str, qid: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = _matcher_of(packed, qid)
        for batch in batches:
            yield from _pairs(pa.Table.from_batches([batch]), packed[qid], match, doc_key, qid).to_batches()

    return task


def _pairs(docs: pa.Table, qids: pa.ChunkedArray, match, doc_key: str, qid: str) -> pa.Table:
    rows, found = [], []
    for row, text in enumerate(docs["text"].to_pylist()):
        for i in match(text or ""):
            rows.append(row)
            found.append(i)
    return pa.table({qid: pa.array(found, qids.type), doc_key: docs[doc_key].take(pa.array(rows, pa.int64()))})

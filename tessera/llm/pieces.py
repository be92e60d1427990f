"""SentencePiece encoding and decoding with a table of distinct marked words.

White space is written as the marker ``▁``. Where no piece of the model has a marker behind another character, no merge reaches
from one marked word (markers and what follows up to the next marker) into the next. So each distinct marked word is segmented once,
and a text's ids are its words' ids, joined by position. Texts are never shuffled: a task keeps the table of the words it has met, in
bounded memory, and starts a new one when it is full.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "▁"
# Memory only, no result depends on them: bytes of the table, characters of a text worked on at once, bytes of a batch sent on.
TABLE_BYTES, SLICE_CHARS, BATCH_BYTES = 64 << 20, 1 << 20, 16 << 20

_WORD = re.compile(f"{MARK}+[^{MARK}]*")
_BORDER = re.compile(f"(?<=[^ {MARK}])[ {MARK}]")


class Pieces:
    """A model and the words segmented so far."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(MARK in name.lstrip(MARK) for name in self.names):
            raise ValueError("the model has pieces that reach over white space: its words cannot be segmented on their own")
        if self.model.normalize("Ａ  a ") != f"{MARK}Ａ{MARK}{MARK}a{MARK}":
            raise ValueError("the model changes texts before it segments them")
        self.begin, self.end = self.model.bos_id(), self.model.eos_id()
        # an empty text has no ids, so a lone marker is known from the start
        self.lone = {MARK: struct.pack("<I", self.model.piece_to_id(MARK))}
        self.table, self.held = dict(self.lone), 0

    def _learn(self, words: set[str]) -> None:
        """Segment words that the table lacks. The model puts a marker in front of what it is given."""
        if self.held > TABLE_BYTES:
            self.table, self.held = dict(self.lone), 0
        new = [w for w in words if w not in self.table]
        ids = [struct.pack(f"<{len(i)}I", *i) for i in self.model.encode([w[1:] for w in new], num_threads=1)]
        self.table.update(zip(new, ids))
        self.held += 200 * len(new) + 2 * sum(map(len, new)) + sum(map(len, ids))

    def encode(self, text: str) -> Iterator[bytes]:
        """The packed ids (little-endian, 32 bits) of the text, slice by slice; slices end where a word does."""
        at = 0
        while at < len(text):
            border = _BORDER.search(text, at + SLICE_CHARS) if at + SLICE_CHARS < len(text) else None
            to = border.start() if border else len(text)
            words = _WORD.findall((MARK if at == 0 else "") + text[at:to].replace(" ", MARK))
            self._learn(set(words))
            yield b"".join(map(self.table.__getitem__, words))
            at = to

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, in slices that start at a marked word."""
        out, at, step = [], 0, SLICE_CHARS // 2
        front = self.model.piece_to_id(MARK + "a")
        while at < len(ids):
            to = min(at + step, len(ids))
            while to < len(ids) and not self.names[ids[to]].startswith(MARK):
                to += 1
            part = ids[at:to].tolist()
            # only the first word loses its marker
            out.append(self.model.decode(part) if at == 0 else self.model.decode([front, *part])[1:])
            at = to
        return "".join(out)


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


def _rows(batches: Iterator[pa.RecordBatch], source: str, made: str, kind: pa.DataType, work) -> Iterator[pa.RecordBatch]:
    """Batches with column ``source`` replaced by ``made``, cut when they have grown large."""
    for batch in batches:
        column, values, size, start = batch.column(source), [], 0, 0
        rest = batch.drop_columns([source])

        def some(end):
            return pa.RecordBatch.from_arrays([*rest.slice(start, end - start).columns, pa.array(values, kind)], names=[*rest.schema.names, made])

        for i in range(batch.num_rows):
            values.append(work(column[i].as_py()))
            size += len(values[-1])
            if size > BATCH_BYTES:
                yield some(i + 1)
                values, size, start = [], 0, i + 1
        if values:
            yield some(batch.num_rows)


def encode(docs: DataFrame, model_path: str, keep: list[Column | str], text: str = "text", made: str = "ids", ends: bool = True) -> DataFrame:
    """Columns ``keep``, then ``made``: the text's ids as packed little-endian 32-bit integers, with begin and end ids if ``ends``.

    Ids are those of the library's ``encode(text)``. A null or empty text has the begin and end ids alone. Texts are encoded whole; a
    long one goes in slices of words, so what a task holds beyond the text itself is bounded, but for a single word without white
    space, which is segmented in one go. Repeated rows get equal ids; an empty table stays empty; names in ``keep`` are free but for ``made``.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model_path)
        head, tail = (np.array([i], "<u4").tobytes() if ends else b"" for i in (pieces.begin, pieces.end))
        yield from _rows(batches, "__text", made, pa.binary(), lambda t: b"".join([head, *pieces.encode(t or ""), tail]))

    rows = docs.select(*keep, F.col(text).alias("__text"))
    return rows.mapInArrow(work, rows.drop("__text").withColumn(made, F.lit(b"")).schema)


def decode(rows: DataFrame, model_path: str, ids: str = "ids", made: str = "decoded") -> DataFrame:
    """``rows`` with ``made``, the text of the packed ids (a column of that name is replaced). Null ids are an empty text."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model_path)
        yield from _rows(batches, "__ids", made, pa.string(), lambda b: pieces.decode(np.frombuffer(b or b"", "<u4")))

    rows = rows.drop(made).withColumn("__ids", F.col(ids))
    return rows.mapInArrow(work, rows.drop("__ids").withColumn(made, F.lit("")).schema)


def digests(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 of every text, encoded with begin and end ids and decoded again."""
    made = decode(encode(docs, model_path, [F.col(key)], text), model_path)
    return made.select(key, F.expr("cast(octet_length(ids) / 4 as bigint)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))

"""SentencePiece encoding by distinct words against the library itself."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tessera.llm import pieces, queries

SF = "/root/testdata/sf0.001"
MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def expected(library, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()


EDGES = [None, "", " ", "   ", "a", "a ", " a", "a  b", "▁", "x▁y ▁ z", "\t\n \r", "ﬁ é é", "\x00a", "<s> </s> <unk> <0x41>", "​", "﻿ a", "日本 語", "a\xa0b", "　", "\U0001f600 \U0001f469‍\U0001f4bb",
         "same same same", "same same same", "e" * 3000, " " * 500 + "x" + " " * 77]


def test_whole_table_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.QUERIES["op13_sentencepiece"](spark, SF).collect()}
    assert found == {r.doc_id: expected(library, r.text) for r in docs.collect()}


def test_edge_texts_repeated_and_null_keys(spark, library):
    rows = [(i if i != 5 else None, t) for i, t in enumerate(EDGES)] + [(3, EDGES[3])]
    found = pieces.digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), MODEL).collect()
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == sorted((k or -1, *expected(library, t)) for k, t in rows)


def test_small_tables_and_slices_change_nothing(library, monkeypatch):
    monkeypatch.setattr(pieces, "TABLE_BYTES", 500)
    monkeypatch.setattr(pieces, "SLICE_CHARS", 10)
    rng, own = random.Random(5), pieces.Pieces(MODEL)
    for _ in range(300):
        text = "".join(rng.choices("ab  ▁é\n日\U0001f600", k=rng.randrange(80)))
        ids = np.frombuffer(b"".join(own.encode(text)), "<u4")
        assert ids.tolist() == library.encode(text)
        assert own.decode(ids) == library.decode(ids.tolist())


def test_very_long_texts(spark, library):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdeé", k=rng.randrange(1, 9))) for _ in range(5000)]
    text = " ".join(rng.choices(words, k=700_000))
    [row] = pieces.digests(spark.createDataFrame([(1, text)], "doc_id long, text string"), MODEL).collect()
    assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == expected(library, text)


def test_empty_table_and_clashing_columns(spark, library):
    docs = spark.createDataFrame([(1, "a b", "x", b"y", "z")], "doc_id long, text string, decoded string, ids binary, n_tokens string")
    assert pieces.digests(docs.limit(0), MODEL).count() == 0
    [row] = pieces.digests(docs, MODEL).collect()
    assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == expected(library, "a b")
    kept = pieces.encode(docs, MODEL, ["text", "decoded", F.col("ids").alias("old")], ends=False).collect()
    assert [(r.text, r.decoded, bytes(r.old), bytes(r.ids)) for r in kept] == [("a b", "x", b"y", np.array(library.encode("a b"), "<u4").tobytes())]
    assert pieces.decode(docs.select("doc_id", F.lit(None).cast("binary").alias("ids")), MODEL).first().decoded == ""

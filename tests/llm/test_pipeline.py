"""Every stage of the pipeline against brute force on the stage's own input, and the cases each must bear."""

import re
import zlib

import numpy as np
import pytest
import regex
import tokenizers
from pyspark.sql import functions as F
from test_llm_operators import brute_align, brute_lines, groups, shingles

import corpus_pipeline
from tessera.llm import decontaminate
from tessera.llm.queries import TOKENIZER
from tessera.session import cut

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def by_id(df):
    return {r.doc_id: r.text for r in df.collect()}


def check_language(before, after):
    assert after == {k: t for k, t in before.items() if t and regex.search(r"\p{L}", t)}


def check_lines(before, after):
    found = brute_lines(sorted(before.items()))
    assert after == {k: text for k, (text, n, gone, _) in found.items() if not gone or gone < n}


def check_near(before, after):
    sets = {k: shingles(t, 5) for k, t in before.items()}
    ids = sorted(sets)
    linked = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    component = groups(ids, linked)
    assert after == {k: before[k] for k in ids if component[k] == k}


def check_leaks(before, after, items):
    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())
    tests = [w for w in map(words, items) if w]
    leaks = set()
    for k, text in before.items():
        w = words(text)
        for t in tests:
            if len(w) < 500 and len(set(w) & set(t)) > len(set(t)) / 3 and brute_align(t, w) / (2 * len(t)) >= max(decontaminate.SHARE, min(8, len(t)) / len(t)):
                leaks.add(k)
    short = {k for k, t in before.items() if len(words(t)) < 500}
    assert leaks and set(after) & short == short - leaks and all(after[k] == before[k] for k in after)


def check_packing(before, packed):
    library = tokenizers.Tokenizer.from_file(TOKENIZER)
    pieces, used = {}, {}
    for r in packed:
        pieces.setdefault(r.doc_id, []).append(r)
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(before)
    for k, text in before.items():
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(pieces[k], key=lambda r: r.piece)
        assert [r.start for r in own] == np.cumsum([0, *[r.length for r in own][:-1]]).tolist() and sum(r.length for r in own) == len(ids)
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes()) for r in own)
        assert all(r.length == 2048 for r in own[1:])
    for spans in used.values():
        ends = np.cumsum([n for _, n in sorted(spans)])
        assert [o for o, _ in sorted(spans)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, check in (("language_id", check_language), ("line_dedup", check_lines), ("near_dedup", check_near), ("decontamination", None)):
        after = cut(STAGES[name](spark, docs, SF))
        assert after.columns == columns
        (check or (lambda a, b: check_leaks(a, b, items)))(by_id(docs), by_id(after))
        docs = after
    packed = STAGES["packing"](spark, docs, SF).collect()
    check_packing(by_id(docs), packed)
    whole = corpus_pipeline.run(spark, SF).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, whole)) == sorted(map(key, packed))


EDGES = [(1, "A line of words that says enough.", "en", "s", 5), (1, "A line of words that says enough.", "en", "s", 5), (None, "Another text, without a key.", "en", None, None), (3, None, None, "s", 0),
         (4, "", "en", "s", 0), (5, "one\ntwo\nthree\n" * 30_000, "en", None, 9), (6, "12 34", "en", "s", 5)]


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_bear_nulls_repeats_long_texts_and_clashing_columns(spark, name):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame(EDGES, schema).withColumns({c: F.lit("mine") for c in ("n_removed", "component_id", "score", "lang_pred", "first", "rest", "kept")})
    made = STAGES[name](spark, docs, SF)
    rows = made.collect()
    texts = {t for _, t, *_ in EDGES}
    if name == "packing":
        assert {r.doc_id for r in rows} == {1, None, 3, 4, 5, 6}
    else:
        assert made.columns == docs.columns and all(r.score == r.rest == r.first == "mine" for r in rows)
        assert all(r.text in texts or r.doc_id == 5 for r in rows)
    counts = {"language_id": 4, "line_dedup": 7, "near_dedup": 6, "decontamination": 7}
    assert name == "packing" or len(rows) == counts[name]
    assert STAGES[name](spark, docs.limit(0), SF).count() == 0

"""Token alignment against brute force over bytes."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
import tokenizers

from tessera.llm import alignment, queries

SF = "/root/testdata/sf0.001"
A, B = (str(public_tokenizers.path(p)) for p in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def byte_table():
    """Characters by which byte-level files write bytes."""
    plain = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def brute(rows):
    """Every token's bytes by hand, overlaps from sets of byte numbers, groups from common ends."""
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    tok = tokenizers.Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    chars = byte_table()
    docs, held, totals = [], [], defaultdict(int)
    for key, text in rows:
        spans = []
        if text:
            enc = tok.encode(" " + text, add_special_tokens=False)
            a = [(i, bytes(chars[c] for c in t)) for i, t in zip(enc.ids, enc.tokens)]
            b = []
            for i in model.encode(text):
                name = model.id_to_piece(i)
                b.append((i, bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode()))
            raw = (" " + text).encode()
            if b"".join(t for _, t in a) == raw and b"".join(t for _, t in b) == raw:
                spans = [a, b]
        if not spans:
            docs.append((key, 0, 0, 0, [], ""))
            held.append(set())
            continue
        owner = []
        for side in spans:
            owner.append([n for n, (_, t) in enumerate(side) for _ in t])
        links = sorted(set(zip(*owner)))
        ids = [(spans[0][x][0], spans[1][y][0]) for x, y in links]
        reach = [np.cumsum([len(t) for _, t in side]).tolist() for side in spans]
        ends = [set(r) for r in reach]
        at, groups = [0, 0], []
        for end in sorted(ends[0] & ends[1]):
            part = []
            for s, side in enumerate(spans):
                own = []
                while at[s] < len(side) and reach[s][at[s]] <= end:
                    own.append(str(side[at[s]][0]))
                    at[s] += 1
                part.append(",".join(own))
            groups.append("|".join(part))
        docs.append((key, len(spans[0]), len(spans[1]), len(groups), ids, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        held.append(set(ids))
    for pairs in held:
        for p in pairs:
            totals[p] += 1
    best = defaultdict(int)
    for (x, _), n in totals.items():
        best[x] = max(best[x], n)
    return sorted(((k, a, b, g, len(ids), sum(totals[p] == best[p[0]] for p in ids), sum(totals[p] for p in ids), h) for k, a, b, g, ids, h in docs), key=str)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


EDGES = [None, "", " ", "a", "  a  b ", "▁", "x▁y", "\t\n\r", "ﬁ é é", "\x00a", "<s></s><|endoftext|> it's", "日本 語", "\U0001f600\U0001f469‍\U0001f4bb", "the cat the cat", "the cat the cat", "don't stop",
         "e" * 150, "<0x41> x", " " * 40]


def test_edges_equal_brute_force(spark):
    rows = [(i if i != 4 else None, t) for i, t in enumerate(EDGES)] + [(3, EDGES[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows)
    assert found(alignment.digests(docs, A, B)) == want
    # no pair, some pairs handed to the tasks
    for handed in (0, 20):
        assert found(alignment.digests(docs, A, B, handed=handed)) == want
    assert alignment.digests(docs.limit(0), A, B).count() == 0
    assert found(alignment.digests(docs.where("doc_id in (0, 1)"), A, B)) == brute(rows[:2])


def test_table_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(alignment.digests(docs, A, B, handed=500)) == brute(rows)


def test_registered_query_on_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = {r.doc_id: r for r in queries.QUERIES["op12_alignment"](spark, SF).collect()}
    assert set(rows) == {r.doc_id for r in docs}
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    for d in docs:
        r = rows[d.doc_id]
        if d.text and "▁" not in d.text:
            assert r.n_b == len(model.encode(d.text)) and r.n_links == r.n_a + r.n_b - r.n_groups and r.n_best <= r.n_links <= r.count_sum


def test_pointers_lead_to_common_ends():
    rng = random.Random(3)
    for _ in range(300):
        size = rng.randrange(1, 60)
        ends = [np.array(sorted(rng.sample(range(1, size), rng.randrange(size))) + [size]) for _ in "ab"]
        common = np.intersect1d(*ends)
        for own, last in zip(ends, alignment.terminals(*ends)):
            assert ends[1][last].tolist() == common[np.searchsorted(common, own)].tolist()
    # one group over all tokens: a chain as long as can be
    odd, even = np.append(np.arange(1, 40_001, 2), 40_002), np.arange(2, 40_003, 2)
    assert {int(x) for part in alignment.terminals(odd, even) for x in part} == {len(even) - 1}


def test_general_outputs_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "it's a cat", "x", 2), (2, None, "y", 3)], "doc_id long, text string, pairs string, uid int")
    one, two = sorted(alignment.align(docs, A, B, ["doc_id", "pairs", "uid"]).collect(), key=lambda r: r.doc_id)
    assert one.end_a[-1] == one.end_b[-1] == len(" it's a cat") and one.pairs == "x" and two.a == [] and two.uid == 3
    assert sorted(set(one.group_a)) == sorted(set(one.group_b)) == list(range(one.group_b[-1] + 1))
    assert len(one.link_a) == len(one.a) + len(one.b) - one.group_b[-1] - 1
    assert found(alignment.digests(docs, A, B)) == brute([(1, "it's a cat"), (2, None)])


def test_very_long_text(spark):
    rng = random.Random(2)
    text = " ".join("".join(rng.choices("abcdeé", k=rng.randrange(1, 9))) for _ in range(300_000)) + " " * 100_000 + "z" * 20_000
    [r] = alignment.digests(spark.createDataFrame([(1, text)], "doc_id long, text string"), A, B).collect()
    # one document: every pair is held once, so all are the best of their id
    assert r.n_best == r.count_sum == r.n_links == r.n_a + r.n_b - r.n_groups

"""Training-data operators against brute force, exact round trips and held-out accuracy, on small inputs."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from tessera.llm import chat, components, decontaminate, hashing, langid, license_rules, licenses, lines, near, packing, queries, substrings, vectors, warc
from tessera.session import work_path

SF = "/root/testdata/sf0.001"
TOKENIZER = str(public_tokenizers.path("byte_bpe_50k.json"))


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def groups(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


# --- decontamination


def brute_align(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (2 if x == y else -1), row[j + 1] - 1, new[-1] - 1))
        best, row = max(best, *new), new
    return best


def test_leaks_equal_brute_force(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    found = {(r.doc_id, r.item_id): r.score for r in decontaminate.find_leaks(docs, items).collect()}
    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower())
    tests = {r.item_id: words(r.text) for r in items.collect()}
    expected = {}
    for r in docs.where("length(text) < 3000").collect():
        w = words(r.text)
        for i, t in tests.items():
            if len(set(w) & set(t)) > len(set(t)) / 3:
                score = brute_align(t, w) / (2 * len(t))
                if score >= max(decontaminate.SHARE, min(8, len(t)) / len(t)):
                    expected[r.doc_id, i] = pytest.approx(score)
    short = {r.doc_id for r in docs.where("length(text) < 3000").select("doc_id").collect()}
    assert {k: v for k, v in found.items() if k[0] in short} == expected
    assert expected


def test_edited_copies_are_leaks_and_clean_ones_are_not(spark):
    item = "the quick brown fox jumps over the lazy dog while seven silent owls watch from an old oak near a river"
    w = item.split()
    rows = [(1, item), (2, "Before. " + item.upper() + " after"), (3, " ".join(x if i % 6 else "other" for i, x in enumerate(w))),
            (4, " ".join(x for i, x in enumerate(w) if i % 7 != 3)), (5, " ".join(itertools.chain.from_iterable((x, "um") if i % 6 == 5 else (x,) for i, x in enumerate(w)))),
            (6, " ".join(w[:14])), (7, "the quick brown fox sleeps all day"), (8, None), (9, ""), (10, "word " * 5000 + item), (11, " ".join(reversed(w)))]
    tests = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "one two"), (5, "all night long five")], "item_id int, text string")
    found = decontaminate.find_leaks(docs_of(spark, rows), tests).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, 1) for i in (1, 2, 3, 4, 5, 6, 10)}
    far = next(r for r in found if r.doc_id == 10)
    assert (far.first_word, far.last_word, far.score) == (5000, 5000 + len(w) - 1, 1.0)
    kept = decontaminate.without_leaks(docs_of(spark, rows), tests)
    assert {r.doc_id for r in kept.collect()} == {7, 8, 9, 11}
    assert decontaminate.find_leaks(docs_of(spark, rows), tests.limit(0)).count() == 0
    assert decontaminate.find_leaks(docs_of(spark, []), tests).count() == 0


def test_long_items_count_by_their_best_chunk(spark):
    words = [f"w{i}" for i in range(1000)]
    tests = spark.createDataFrame([(1, " ".join(words))], "item_id int, text string")
    found = decontaminate.find_leaks(docs_of(spark, [(1, " ".join(words[256:500])), (2, "nothing of it")]), tests).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(1, 1)]


def test_items_just_longer_than_a_chunk_have_no_short_rest(spark):
    for size in range(257, 264):
        item = " ".join([f"w{i}" for i in range(size - 7)] + "the best in the world and more".split())
        tests = spark.createDataFrame([(1, item)], "item_id int, text string")
        rows = [(1, "a quite unrelated document about tea the best in the world and more"), (2, "x " + item), (3, " ".join(item.split()[:120]))]
        assert [r.doc_id for r in decontaminate.find_leaks(docs_of(spark, rows), tests).orderBy("doc_id").collect()] == [2, 3]


# --- archives


def brute_pages(rows):
    same = defaultdict(list)
    for key, html in rows:
        same[html or ""].append(key)
    out = []
    for key, html in rows:
        body = (html or "").encode()
        digest = __import__("base64").b32encode(hashlib.sha1(body).digest()).decode()
        first = max(same[html or ""])
        out.append((key, len(body), digest, "response" if key == first else "revisit", None if key == first else first))
    return sorted(out)


def test_archives_equal_brute_force(spark):
    rows = [(i, f"<p>{i // 3}</p>") for i in range(20)] + [(30, None), (31, ""), (32, "é" * 70_000), (33, "a\r\n\r\nWARC/1.1\r\nContent-Length: 9\r\n\r\n"), (34, "\r\n\r\n")]
    pages = spark.createDataFrame([(k, f"http://x/{k}", h) for k, h in rows], "page_id long, url string, html string").repartition(4)
    found = warc.captures(spark, pages).drop("url").collect()
    assert sorted(tuple(r) for r in found) == brute_pages(rows)


def test_archives_with_nulls_repeats_and_small_payloads(spark):
    pages = spark.createDataFrame([(2, None, "x"), (2, None, "x"), (None, "u\r\nv", "x"), (1, "w", "")], "page_id long, url string, html string")
    found = warc.captures(spark, pages).collect()
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in found) == Counter([(2, "response", None), (2, "revisit", 2), (None, "revisit", 2), (1, "response", None)])
    assert warc.captures(spark, pages.limit(0)).count() == 0
    path = work_path(spark, "warc")
    warc.write_captures(pages, path, min_bytes=2)
    records = warc.read_records(spark, path)
    assert {r.type for r in records.collect()} == {"request", "response", "metadata"}
    assert {bytes(r.payload) for r in records.where("type = 'response'").collect()} == {b"x", b""}
    nested = warc.assemble(records).collect()
    assert len(nested) == 4 and all(r.request.concurrent_to == r.capture.record_id and r.n_metadata == 1 for r in nested)


def test_metadata_reach_their_capture_through_the_request(spark):
    columns = "record_id string, type string, concurrent_to string"
    records = spark.createDataFrame([("a", "response", None), ("r", "request", "a"), ("m", "metadata", "r"), ("n", "metadata", "a"), ("z", "metadata", "gone"), ("b", "revisit", None)], columns)
    found = {r.capture.record_id: (r.request and r.request.record_id, r.metadata and r.metadata.record_id, r.n_metadata) for r in warc.assemble(records).collect()}
    assert found == {"a": ("r", "m", 2), "b": (None, None, 0)}


# --- language


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert len(found) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_bundles_equal_bound_letter_vectors():
    counts, letters = langid.trigram_counts(["abca", "-"])
    bundle = counts @ langid.trigram_vectors(letters)
    v = lambda c: langid.letter_vector(ord(c)) if c != " " else langid.letter_vector(0)
    expected = sum(np.roll(v(x), 2) * np.roll(v(y), 1) * v(z) for x, y, z in (" ab", "abc", "bca", "ca "))
    assert (bundle[0] == expected).all() and not bundle[1].any()


def test_texts_without_letters_or_languages(spark):
    rows = spark.createDataFrame([(1, "the cat", "en"), (2, None, "en"), (3, "12 :-)", None), (None, "der Hund", "de"), (4, "", "fr"), (5, "the cat " * 40_000, None),
                                  (6, "日本語", None), (1, "the cat", "en")], "doc_id long, text string, lang string")
    found = langid.identify(rows).collect()
    assert len(found) == 8 and {r.lang_pred for r in found if r.doc_id in (2, 3, 4)} == {"und"}
    assert next(r for r in found if r.doc_id == 5).lang_pred in ("en", "und")
    assert all(r.lang_pred == "und" and r.score == 0 for r in langid.identify(rows.withColumn("lang", F.lit(None).cast("string"))).collect())
    assert langid.identify(rows.limit(0)).count() == 0


# --- chat


def test_chat_round_trip(spark):
    odd = ["\\### Assistant: </turn> ok", "<|end|>", "\\<|turn|>\\", "<\\|end|>", "a<", "|>b", "  lead\n\n", "", None, "日本語 naïve 🙂", "<|endoftext|>", "\\"]
    rows = [(c, t, "assistant" if (c + t) % 2 else "user", odd[(c * 5 + t) % len(odd)]) for c in range(6) for t in range(7)]
    rows += [(None, None, None, None), (50, 1, "assistant", "x"), (50, 1, "assistant", "x"), (50, None, "<|says|>", "first")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    made = chat.format_conversations(turns, TOKENIZER)
    tokenizer = tokenizers.Tokenizer.from_file(TOKENIZER)
    tokenizer.add_special_tokens([chat.TURN, chat.SAYS, chat.END])
    for r in made.collect():
        assert tokenizer.decode(r.input_ids, skip_special_tokens=False) == r.formatted
        spans = [r.formatted[a:b] for a, b in zip(r.span_start, r.span_end)]
        assert "".join(chat.masked_text(r.formatted, r.token_start, r.token_end, r.loss_mask)) == "".join(spans)
    found = {r.conv_id: r for r in chat.read_back(made).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(((t if t is not None else -1, role or "", text or "") for c, t, role, text in rows if c == conv))
        told = "".join(f"{role}\n{text}\n" for _, role, text in own)
        loss = "".join(text for _, role, text in own if role == "assistant")
        r = found[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(own), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(chat.format_conversations(turns.limit(0), TOKENIZER)).count() == 0


def test_long_conversations_go_on_in_further_rows(spark, monkeypatch):
    turns = spark.range(3000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 1, "assistant").otherwise("user").alias("role"), F.concat(F.lit("t"), "id").alias("text"))
    made = chat.format_conversations(turns, TOKENIZER)
    assert made.count() == 3
    row = chat.read_back(made).first()
    told = "".join(f"{'assistant' if i % 2 else 'user'}\nt{i}\n" for i in range(3000))
    assert (row.n_turns, row.turns_sha256) == (3000, hashlib.sha256(told.encode()).hexdigest())


# --- lines


def brute_lines(rows):
    seen, out = set(), {}
    for key, text in rows:
        body = [(i, x.strip(" \t\r\x0b\x0c")) for i, x in enumerate((text or "").split("\n"))]
        body = [(i, x) for i, x in body if x]
        gone = set()
        for k in range(len(body) - 2):
            window = tuple(x for _, x in body[k:k + 3])
            if window in seen:
                gone |= {k, k + 1, k + 2}
            seen.add(window)
        drop = {body[k][0] for k in gone}
        out[key] = (None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop), len(body), len(gone), sum(k - 1 not in gone for k in gone))
    return out


def test_lines_equal_brute_force(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\n b \n\nc\nd\t\ny"), (3, "a\na\na\na\na"), (4, None), (5, ""), (6, "\n\n\n"), (7, "a\nb"), (8, "é\nü\nß\n" * 50_000), (9, "a\nb\nc\nd"), (10, "q\na\nb\nc\nd")]
    found = {r.doc_id: (r.text, r.n_lines, r.n_removed, r.n_spans) for r in lines.dedup_lines(docs_of(spark, rows)).collect()}
    assert found == brute_lines(rows)
    assert lines.dedup_lines(docs_of(spark, [])).count() == 0


def test_lines_with_repeated_and_null_keys(spark):
    rows = [(None, "a\nb\nc"), (1, "a\nb\nc"), (1, "a\nb\nc"), (1, "other")]
    found = lines.dedup_lines(docs_of(spark, rows).withColumn("n_removed", F.lit("clash")).withColumn("at", F.lit(7)))
    assert found.columns == ["doc_id", "text", "at", "n_lines", "n_removed", "n_spans"]
    assert Counter((r.doc_id, r.text, r.at) for r in found.collect()) == Counter([(None, "a\nb\nc", 7), (1, "", 7), (1, "", 7), (1, "other", 7)])


# --- substrings


def brute_substrings(rows):
    seen, out = set(), []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        body = (text or "").encode()
        gone = np.zeros(len(body) + 1, bool)
        for p in range(len(body) - 99):
            if body[p:p + 100] in seen:
                gone[p:p + 100] = True
            seen.add(body[p:p + 100])
        rest = bytes(b for b, g in zip(body, gone) if not g)
        out.append((key, len(body), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), hashlib.sha256(rest).hexdigest()))
    return Counter(out)


def substring_rows():
    rng = np.random.default_rng(3)
    word = lambda n: "".join(rng.choice(list("abcdé "), n))
    passage = word(400)
    rows = [(i, word(int(rng.integers(0, 300))) + passage[(a := int(rng.integers(0, 300))):a + int(rng.integers(60, 200))] + word(50)) for i in range(40)]
    return rows + [(50, "ab" * 400), (51, "x" * 350), (52, "x" * 99), (None, "ab" * 80), (53, None), (54, ""), (55, "é" * 200), (55, "é" * 200), (56, passage[:100]), (57, passage[300:399])]


def test_substrings_equal_brute_force(spark):
    rows = substring_rows()
    found = substrings.dedup_substrings(docs_of(spark, rows)).collect()
    assert Counter(tuple(r) for r in found) == brute_substrings(rows)
    assert substrings.dedup_substrings(docs_of(spark, [])).count() == 0


def test_substrings_in_small_blocks_chunks_and_heavy_anchors(spark, monkeypatch):
    rows = [r for r in substring_rows() if r[0] is not None] + [(60, "".join(np.random.default_rng(9).choice(list("abcd"), 4_000)))]
    rows.append((61, rows[-1][1][1_500:3_000]))
    bodies = [(t or "").encode() for _, t in rows]
    whole = {bodies[n][a + before:b + before + 99] for data, offsets, numbers, before in substrings._chunks(bodies)
             for a, b, n in ((f - offsets[t], e - offsets[t], numbers[t]) for f, e, _, t, _ in zip(*substrings.anchors(data, offsets)))}
    monkeypatch.setattr(substrings, "CHUNK", 700)
    parts = {bodies[n][a + before:b + before + 99] for data, offsets, numbers, before in substrings._chunks(bodies)
             for a, b, n in ((f - offsets[t], e - offsets[t], numbers[t]) for f, e, _, t, _ in zip(*substrings.anchors(data, offsets)))}
    # a long text in overlapping parts has the same suffixes
    assert {p[i:i + 100] for p in whole for i in range(len(p) - 99)} == {p[i:i + 100] for p in parts for i in range(len(p) - 99)}
    monkeypatch.setattr(substrings, "HEAVY", 3)
    monkeypatch.setattr(substrings, "BLOCK", 500)
    import pyarrow as pa
    table = pa.Table.from_batches(list(substrings._count_anchors(4)(iter([pa.RecordBatch.from_pydict({"uid": list(range(len(rows))), "body": [__import__("zstandard").compress(b) for b in bodies]})]))))
    wanted, heavy = defaultdict(set), set()
    for b in range(4):
        for uid, h in zip(*substrings._repeated(table.filter(pa.compute.equal(table["bucket"], b))).to_pydict().values()):
            heavy.add(h) if uid is None else wanted[uid].add(h)
    assert heavy
    batch = pa.RecordBatch.from_pydict({"uid": list(wanted), "key": [rows[u][0] for u in wanted], "body": [__import__("zstandard").compress(bodies[u]) for u in wanted],
                                        "wanted": [sorted(w) for w in wanted.values()], "heavy": pa.array([sorted(w & heavy) for w in wanted.values()], pa.list_(pa.int64()))})
    table = pa.Table.from_batches(list(substrings._pieces(4)(iter([batch]))))
    runs = defaultdict(list)
    for b in range(4):
        for uid, start, n in zip(*substrings._sorted_bucket(table.filter(pa.compute.equal(table["bucket"], b))).to_pydict().values()):
            runs[uid].append((start, n))
    out = []
    for uid, (key, _) in enumerate(rows):
        a, b = substrings.merged(*(np.array(x) for x in zip(*runs[uid]))) if runs[uid] else (np.zeros(0, int), np.zeros(0, int))
        rest = b"".join(bodies[uid][x:y] for x, y in zip([0, *b], [*a, len(bodies[uid])]))
        out.append((key, len(bodies[uid]), len(bodies[uid]) - len(rest), len(a), hashlib.sha256(rest).hexdigest()))
    assert Counter(out) == brute_substrings(rows)


# --- vectors


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((30, 64))
    rows = [(i, (base[i % 30] + rng.standard_normal(64) * rng.choice([0.02, 0.12, 0.3])).tolist(), int(i % 30) % 3) for i in range(400)]
    rows += [(1000 + i, base[0].tolist(), 0) for i in range(50)] + [(2000, (base[0] * 1e-200).tolist(), 0), (2001, (base[0] * 1e150).tolist(), 0), (2002, base[0].tolist(), None), (2003, None, 0), (2004, [], 0),
             (2005, [0.0] * 64, 0), (2006, [None] + [1.0] * 63, 0), (2007, [float("nan")] * 64, 0), (2008, [float("inf")] * 64, 0), (2009, base[0][:32].tolist(), 0), (7, rows[7][1], rows[7][2])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    found = vectors.near_vectors(table).collect()
    good = [(n, k, np.array(v) / np.abs(v).max(), lab) for n, (k, v, lab) in enumerate(rows) if lab is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    linked = [(a, b) for a, b in itertools.combinations(good, 2) if a[3] == b[3] and len(a[2]) == len(b[2]) and a[2] @ b[2] / np.linalg.norm(a[2]) / np.linalg.norm(b[2]) >= 0.98]
    degree = Counter(x[0] for pair in linked for x in pair)
    component = groups(range(len(rows)), [(a[0], b[0]) for a, b in linked])
    low = defaultdict(lambda: 10 ** 9)
    for n, r in enumerate(rows):
        low[component[n]] = min(low[component[n]], r[0])
    assert Counter(tuple(r) for r in found) == Counter((r[0], degree[n], low[component[n]], r[0] == low[component[n]]) for n, r in enumerate(rows))
    assert vectors.near_vectors(table.limit(0)).count() == 0


def test_large_buckets_are_dealt_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    center = rng.standard_normal(16)
    rows = [(i, (center + rng.standard_normal(16) * 0.05).tolist(), 1) for i in range(120)]
    monkeypatch.setattr(vectors, "BLOCK", 20)
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    degree = (x @ x.T >= 0.98).sum(axis=1) - 1
    found = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert [r.n_links for r in found.orderBy("vec_id").collect()] == degree.tolist()


def test_estimates_are_unbiased_and_bounds_hold():
    rng = np.random.default_rng(6)
    a = rng.standard_normal((4000, 64))
    b = a * 0.9 + rng.standard_normal((4000, 64)) * 0.5
    a, b = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (a, b))
    signs, factor = vectors.code(a)
    turned = b @ vectors.rotation(64, 0)
    true = (a * b).sum(axis=1)
    bound = vectors.upper_bound(signs, factor, turned)
    estimate = np.where(signs, 1.0, -1.0) / 8 / factor[:, None] * turned
    assert abs((estimate.sum(axis=1) - true).mean()) < 0.005
    assert (bound >= true).mean() > 0.9995


# --- packing


def test_packing_equals_the_tokenizer_and_fills_sequences(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = [(-1, None), (-2, ""), (-3, "a<|endoftext|>b\n\n  x  "), (-4, "word " * 20_000), (-4, "word " * 20_000), (None, "日本語 don't 12")]
    rows = docs.unionByName(docs_of(spark, extra))
    found = packing.pack_documents(rows, TOKENIZER, with_ids=True).collect()
    tokenizer = tokenizers.Tokenizer.from_file(TOKENIZER)
    expected = Counter()
    for r in rows.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        starts = [0] + list(range(first if len(ids) > 2048 else len(ids), len(ids), 2048))
        for p, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            expected[r.doc_id, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    sequences = defaultdict(list)
    for r in found:
        assert len(r.ids) == r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1]] and sum(n for _, n in parts) <= 2048
    assert len(sequences) <= -(-sum(r.length for r in found) // 2048) * 1.05 + 1
    assert packing.pack_documents(docs_of(spark, []), TOKENIZER).count() == 0


def test_pack_sizes_takes_the_least_sum_of_squares():
    rng = np.random.default_rng(8)
    sizes = rng.integers(1, 21, 300)
    where, offset, used = packing.pack_sizes(sizes, 20)
    fills: list[int] = []
    for s, q, o in zip(sizes, where, offset):
        squares = lambda f: sum(n * n for h, n in Counter(f).items() if h < 20)
        options = [(squares([*fills[:i], fills[i] + s, *fills[i + 1:]]), -fills[i]) for i in range(len(fills)) if fills[i] + s <= 20] + [(squares([*fills, s]), 0)]
        if q == len(fills):
            fills.append(0)
        assert fills[q] == o
        fills[q] += s
        assert squares(fills) == min(options)[0]
    assert used == len(fills)


# --- near duplicates


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates_equal_brute_force(spark, n):
    rng = np.random.default_rng(n)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [list(rng.choice(vocabulary, int(rng.integers(5, 200)))) for _ in range(12)]
    rows = []
    for i in range(150):
        w = list(base[i % 12])
        for _ in range(int(rng.integers(0, 1 + len(w) // 12))):
            w[int(rng.integers(len(w)))] = str(rng.choice(vocabulary))
        rows.append((i, " ".join(w)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "One"), (204, "one"), (205, "ONE two"), (206, "é " * 30_000), (207, "É " * 30_000), (5, rows[5][1])]
    sets = [shingles(t, n) for _, t in rows]
    linked = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    component = groups(range(len(rows)), linked)
    low = defaultdict(lambda: 10 ** 9)
    for i, r in enumerate(rows):
        low[component[i]] = min(low[component[i]], r[0])
    found = near.near_duplicates(docs_of(spark, rows).withColumn("digest", F.lit(1)).withColumn("kept", F.lit("clash")), n=n).collect()
    assert Counter((r.doc_id, r.text, r.n_shingles, r.component_id, r.kept) for r in found) == Counter(
        (r[0], r[1], len(sets[i]), low[component[i]], r[0] == low[component[i]]) for i, r in enumerate(rows))
    empty = sum(1 for s in sets if not s)
    assert sum(r.first for r in found) == len({component[i] for i in range(len(rows)) if sets[i]}) + empty
    assert near.near_duplicates(docs_of(spark, []), n=n).count() == 0


def test_long_lists_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near, "SHORT", 3)
    monkeypatch.setattr(near, "LEADERS", 1)
    rng = np.random.default_rng(1)
    text = [f"t{i}" for i in range(60)]
    rows = []
    for i in range(60):
        w = list(text)
        for j in rng.choice(60, 3, replace=False):
            w[j] = f"x{i}"
        rows.append((i, " ".join(w)))
    sets = [shingles(t, 2) for _, t in rows]
    linked = [(a, b) for a, b in itertools.combinations(range(60), 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    found = {r.doc_id: r.component_id for r in near.near_duplicates(docs_of(spark, rows), n=2).collect()}
    assert found == groups(range(60), linked)


@pytest.mark.parametrize("n", [2, 5])
def test_blocks_of_copies_that_leaders_leave_apart(spark, monkeypatch, n):
    """Loose copies of one text, most linked with none; pairs of them that differ in little; sizes on both sides of a range."""
    monkeypatch.setattr(near, "SHORT", 3)
    monkeypatch.setattr(near, "LEADERS", 1)
    monkeypatch.setattr(near, "BLOCK_ROWS", 7)
    monkeypatch.setattr(near, "BLOCK_VALUES", 900)
    rng = np.random.default_rng(n)
    text = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(80):
        w = list(text[:int(rng.integers(100, 121))])
        for j in rng.choice(len(w), int(rng.integers(3, 12)) * 2 // n, replace=False):
            w[j] = f"x{i}"
        rows.append((i, " ".join(w)))
        if i % 8 == 0:
            rows.append((100 + i, " ".join([*w, "and", "more"])))
    sets = {i: shingles(t, n) for i, t in rows}
    linked = [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    taken = []
    monkeypatch.setattr(near, "_in_blocks", lambda *a, f=near._in_blocks: taken.append(1) or f(*a))
    found = {r.doc_id: r.component_id for r in near.near_duplicates(docs_of(spark, rows), n=n).collect()}
    assert found == groups(list(sets), linked) and taken


def test_components_of_paths_stars_and_cycles(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(100 + i, 300) for i in range(50)]
    cycle = [(400 + i, 400 + (i + 1) % 7) for i in range(7)] + [(500, 500)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(path + star + cycle, "a long, b long")).collect()}
    assert found == {k: v for k, v in groups([*range(61), *range(100, 150), 300, *range(400, 407)], path + star + cycle[:-1]).items()}


# --- licences


def brute_scan(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    normal = f" {' '.join(words)} "
    starts, base = [], set()
    for phrase, label in license_rules.BASE:
        p = phrase.split()
        own = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        starts += own
        base |= {label} if own else set()
    hits = []
    for i, label, rank, one, two, pattern in license_rules.rules():
        if one in words and two in words:
            hits += [(m.start(), m.end(), rank, i, label) for m in re.finditer(pattern, normal)]
    left = [d for d in hits if not any(e is not d and e[0] <= d[0] and e[1] >= d[1] and e[2] <= d[2] and (e[:2] != d[:2] or (e[2], e[3]) < (d[2], d[3])) for e in hits)]
    labels = base | {d[4] for d in left}
    score = 1.0 if starts else max([license_rules.WEIGHT[d[2]] for d in left], default=0.0)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score)


def test_license_scan_equals_brute_force(spark):
    rows = [(1, "Licensed under the MIT License. SPDX-License-Identifier: Apache-2.0. under the mit license under the MIT license"), (2, None), (3, ""), (4, "..."),
            (5, "released under the gnu gpl version 3 or later, gpl license"), (6, "Apache License, Version 2.0; CC BY-NC-SA 4.0. Available under CC BY NC"), (7, "é under the mit license é"),
            (8, "All rights reserved. Unauthorized copying of this text is strictly prohibited."), (9, "licensed under the terms of the bsd 3-clause license " * 3000), (10, "under the mit licenses"),
            (11, "distributed under the GNU General Public License version 2, or under the BSD license"), (1, "mit license")]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(docs_of(spark, rows)).withColumn("labels", F.lit("clash"))
    found = licenses.scan_licenses(docs).collect()
    for r in found:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == brute_scan(r.text), r.text
    assert licenses.scan_licenses(docs.limit(0)).count() == 0
    assert len(license_rules.rules()) > 300


# --- hashing


def test_hashes_are_equal_wherever_the_bytes_stand():
    data = np.frombuffer("ab cd ab  ef\nab".encode(), np.uint8)
    starts, ends, text = hashing.words(data, np.array([0, 5, len(data)]), hashing.separators(r"\s"))
    assert [data[a:b].tobytes() for a, b in zip(starts, ends)] == [b"ab", b"cd", b"ab", b"ef", b"ab"] and text.tolist() == [0, 0, 1, 1, 1]
    h = hashing.Prefix(data).hashes(starts, ends)
    assert h[0] == h[2] == h[4] and len(set(h.tolist())) == 3


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered_queries_return_rows(spark, name):
    frame = queries.QUERIES[name](spark, SF)
    assert frame.count() > 0 and re.fullmatch(r"op\d+_\w+", name)

"""Conversation repair against exhaustive search."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from tessera.llm import queries, repair

SF = "/root/testdata/sf0.001"
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(k, 1)
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        last = SOLID.findall(text)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
        seen.add((role, text))
    return out


def search(rows, bad, most_inserts=2):
    """Cost, edits and rows of the best repair, by trying all edits with every choice of role."""
    extra = [""] + [a for a in "ua"] + ([a + b for a in "ua" for b in "ua"] if most_inserts == 2 else [])

    @lru_cache(None)
    def best(i, tail):
        """Least (cost, edits, lines) from row i on, with the initials so far ending in ``tail``."""
        found = []
        fits = lambda initials: re.fullmatch("s?(ua)*u?", initials)
        for more in extra:
            t = tail + more
            if not fits(t):
                continue
            cost, edits, lines = 2 * len(more), "I" * len(more), tuple({"u": "user:", "a": "assistant:"}[c] for c in more)
            if i == len(rows):
                if re.fullmatch("(s?(ua)+)?", t):
                    found.append((cost, edits, lines))
                continue
            _, _, role, text = rows[i]
            options = [(3, "D", "", ())]
            if bad[i] in ("", "truncated"):
                late = bad[i] == "truncated"
                if role[:1]:
                    options.append((late, "K", role[0], (f"{role}:{text}",)))
                options += [(2 + late, "R", c, (f"{n}:{text}",)) for c, n in (("u", "user"), ("a", "assistant"))]
            for c, e, initial, line in options:
                if fits(t + initial):
                    rest = best(i + 1, re.sub("(ua)+", "ua", t + initial))
                    if rest:
                        found.append((cost + c + rest[0], edits + e + rest[1], lines + line + rest[2]))
        return min(found) if found else None

    return best(0, "")


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        own = order([r for r in damage(rows) if r[0] == conv])
        out.append((conv, *measured(own)))
    return sorted(out, key=str)


def measured(own):
    bad = faults(own)
    turns = [r[1] for r in own if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
    cost, audit, lines = search(own, bad)
    return (gaps, bad.count("blank"), bad.count("duplicate"), bad.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def found(df):
    names = ["conv_id", *repair.NUMBERS, "audit", "repaired_sha256"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def turns_of(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


def test_whole_table_equals_exhaustive_search(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    assert found(queries.QUERIES["op11_repair"](spark, SF)) == brute(rows)


def random_rows(rng, conv, most=7):
    roles, texts = ["user", "assistant", "system", "tool", None, "", "user", "assistant"], ["a.", "b!", "c", "", " \t", None, "d?  ", "é", "e.", "f.", "g.", "h."]
    return [(conv, rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts)) for _ in range(rng.randrange(1, most))]


def test_random_conversations_equal_exhaustive_search(spark):
    rng = random.Random(4)
    rows = [r for conv in [None, *range(150)] for r in random_rows(rng, conv)]
    rows += [(900 + i, i, None, None) for i in range(4)] + [(990, 1, "user", "x.")] * 3
    assert found(repair.damage_and_repair(turns_of(spark, rows))) == brute(rows)


def solve(kinds):
    own, edits = repair.Survivors(), []
    for k in kinds:
        edits.append(own.step(*k))
    cost, rest = own.finish()
    return cost, "".join(edits) + rest


def test_search_equals_exhaustive_search_without_spark():
    rng = random.Random(9)
    for _ in range(1500):
        rows, bad = [], []
        for i in range(rng.randrange(9)):
            rows.append((0, i, rng.choice(["user", "assistant", "system", "tool"]), f"{i}"))
            bad.append(rng.choice(["", "", "", "truncated", "blank"]))
        cost, audit, _ = search(rows, bad)
        assert solve([(r[2][:1], b == "blank", b == "truncated") for r, b in zip(rows, bad)]) == (cost, audit)


def size(own):
    held, todo = 0, [own.root]
    while todo:
        node = todo.pop()
        held += 1
        todo += node.children
    return held


def test_long_good_conversations_need_little_memory():
    own, most = repair.Survivors(), 0
    for i in range(20_000):
        own.step("ua"[i % 2], i % 7 == 3, i % 11 == 0)
        most = max(most, size(own))
    assert most < 200


def test_ties_that_part_far_back():
    # rows without a role of their own: an odd number of them needs one edit more, and the least string has it first
    n = 2001
    cost, audit = solve([("t", False, False)] * n)
    assert (cost, audit) == (2 * (n - 1) + 3, "D" + "R" * (n - 1))
    small = [solve([("t", False, False)] * k) for k in (3, 5, 7)]
    assert [s[1] for s in small] == [search([(0, i, "tool", str(i)) for i in range(k)], [""] * k)[1] for k in (3, 5, 7)]


def test_repaired_rows_nulls_and_other_columns(spark):
    rows = [(1, 0, "system", "s."), (1, 2, "assistant", "x"), (1, 1, "tool", "q."), (2, None, "user", None), (None, 1, "user", "q.")]
    turns = turns_of(spark, rows).selectExpr("*", "'z' as audit", "1 as kind", "'m' as mark", "0 as place")
    made = repair.repair(turns, repair.audits(turns))
    assert [(r.conv_id, r.place, r.turn, r.edit, r.role, r.text) for r in sorted(made.collect(), key=lambda r: (r.conv_id or 0, r.place))] == [
        (None, 0, 1, "K", "user", "q."), (None, 1, None, "I", "assistant", ""), (1, 0, 0, "K", "system", "s."), (1, 1, 1, "R", "user", "q."), (1, 2, 2, "K", "assistant", "x")]
    assert repair.damage_and_repair(turns.limit(0)).count() == 0
    assert repair.audits(turns.limit(0)).count() == 0


def test_very_long_text_and_hot_conversation(spark):
    long = "word " * 400_000
    rows = [(1, 0, "user", long + "."), (1, 1, "assistant", long)] + [(2, i, ("user", "assistant")[i % 2], f"{i}.") for i in range(20_000)]
    got = {r.conv_id: r for r in repair.digests(turns_of(spark, rows)).collect()}
    assert got[1].audit == "KK" and (got[1].cost, got[1].truncated) == (1, 1)
    assert got[2].audit == "K" * 20_000 and got[2].cost == 0
    assert got[1].repaired_sha256 == hashlib.sha256(f"user:{long}.\nassistant:{long}".encode()).hexdigest()


@pytest.mark.parametrize("text,blank,closed", [("a. \t\n", False, True), ("a\x0b.\x0c", False, True), ("\xa0", False, False), (" \x0d", True, False), ("。", False, False)])
def test_faults_of_texts(spark, text, blank, closed):
    [r] = repair.audits(turns_of(spark, [(1, 1, "user", text)])).collect()
    assert (r.blank, r.truncated) == (int(blank), int(not blank and not closed))

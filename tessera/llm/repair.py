"""Repair of conversations by the cheapest edits, found by a Viterbi search whose survivors coalesce.

A good conversation is ``(s?(ua)+)?`` in its roles' initials. Rows are read in order; for each of four states (nothing yet, after
s, after u, after a) the cheapest edits that lead there survive. Survivors are leaves of a tree of back pointers with reference counts:
a branch without a survivor goes, and once all survivors share an ancestor the edits up to it are final and leave the tree. So
a task holds what is undecided, not the conversation.

Edits of equal cost go by their whole strings. Two survivors after the same row never have equal strings, nor is one the start of the
other (both end in a row's edit). So the order of their whole undecided strings is carried on as a rank, and strings that
part anywhere in the past compare in one step.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, AFTER_S, AFTER_U, AFTER_A = range(4)
# Where an initial leads from each state, what each edit costs, what ends a conversation in each state.
GRAMMAR = {START: {"s": AFTER_S, "u": AFTER_U}, AFTER_S: {"u": AFTER_U}, AFTER_U: {"a": AFTER_A}, AFTER_A: {"u": AFTER_U}}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
ENDINGS = {START: "", AFTER_S: "II", AFTER_U: "I", AFTER_A: ""}
LEGAL = {"su", "ua", "au"}
BLANKS = " \t\n\x0b\x0c\r"
ROLES = {"u": "user", "a": "assistant"}


def _steps(initial: str, doomed: bool, truncated: bool) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, edits) for a row. An insertion just before a deletion is never cheaper and never comes first."""
    steps = [(state, state, DELETE, "D") for state in GRAMMAR]
    if doomed:
        return steps
    for state in GRAMMAR:
        before = [(state, 0, "")] + [(to, INSERT, "I") for c, to in GRAMMAR[state].items() if c in ROLES]
        for here, cost, edits in before:
            for c, to in GRAMMAR[here].items():
                if c == initial:
                    steps.append((state, to, cost + TRUNCATED * truncated, edits + "K"))
                if c in ROLES:
                    steps.append((state, to, cost + REROLE + TRUNCATED * truncated, edits + "R"))
    return steps


STEPS = {(i, d, t): _steps(i, d, t) for i in ("s", "u", "a", "") for d in (False, True) for t in (False, True)}


class _Node:
    __slots__ = ("parent", "edits", "children", "refs")

    def __init__(self, parent: _Node | None, edits: str):
        self.parent, self.edits, self.children, self.refs = parent, edits, [], 0


class Survivors:
    """The cheapest, then ASCII-least edits into each state, and what of them is undecided."""

    def __init__(self):
        self.root = _Node(None, "")
        self.root.refs = 1
        self.best: dict[int, tuple[int, int, _Node]] = {START: (0, 0, self.root)}  # cost, rank, leaf

    def step(self, initial: str, doomed: bool, truncated: bool) -> str:
        """Take a row; the edits that have become final."""
        found: dict[int, tuple[int, int, str, int]] = {}
        for state, to, cost, edits in STEPS[initial if initial in ("s", "u", "a") else "", doomed, truncated]:
            if state in self.best:
                c, rank, _ = self.best[state]
                made = (c + cost, rank, edits, state)
                if to not in found or made < found[to]:
                    found[to] = made
        for state in self._beaten(found):
            del found[state]
        old, self.best = self.best, {}
        for rank, (_, edits, state, to, cost) in enumerate(sorted((r, e, s, to, c) for to, (c, r, e, s) in found.items())):
            parent = old[state][2]
            leaf = _Node(parent, edits)
            leaf.refs = 1
            parent.children.append(leaf)
            parent.refs += 1
            self.best[to] = (cost, rank, leaf)
        for _, _, leaf in old.values():
            self._release(leaf)
        out = []
        while self.root.refs == 1 and self.root.children:
            self.root = self.root.children[0]
            self.root.parent = None
            out.append(self.root.edits)
        return "".join(out)

    @staticmethod
    def _beaten(found: dict[int, tuple[int, int, str, int]]) -> set[int]:
        """States that no best ending starts from: another state can do as they would, for surely less."""
        cost = {state: f[0] for state, f in found.items()}
        far = 1 << 60
        start, s, u, a = (cost.get(x, far) for x in (START, AFTER_S, AFTER_U, AFTER_A))
        out = set()
        if a + DELETE < start or u + INSERT + DELETE < start:  # at worst the s it would keep is deleted
            out.add(START)
        if min(start, a) < s or u + INSERT < s:
            out.add(AFTER_S)
        if min(start, a) + INSERT < u:
            out.add(AFTER_U)
        if start < a or u + INSERT < a:
            out.add(AFTER_A)
        return out & set(found)

    @staticmethod
    def _release(node: _Node | None) -> None:
        while node is not None:
            node.refs -= 1
            if node.refs:
                return
            if node.parent is not None:
                node.parent.children.remove(node)
            node = node.parent

    def finish(self) -> tuple[int, str]:
        """Cost of the whole conversation, and the edits that were still open."""
        cost, _, state = min((c + INSERT * len(ENDINGS[s]), rank, s) for s, (c, rank, _) in self.best.items())
        out, node = [ENDINGS[state]], self.best[state][2]
        while node is not self.root:
            out.append(node.edits)
            node = node.parent
        return cost, "".join(reversed(out))


class _Audit:
    """Faults and edits of one conversation, row by row."""

    def __init__(self):
        self.survivors, self.edits = Survivors(), []
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.last = self.last_role = None
        self.low = self.high = None
        self.turns = 0

    def add(self, turn, role: str, mark: bytes, again: bool, blank: bool, closed: bool) -> None:
        again = again or (turn, role, mark) == self.last
        fault = "blank" if blank else "duplicate" if again else None if closed else "truncated"
        if fault:
            self.counts[fault] += 1
        if self.last_role is not None and self.last_role[:1] + role[:1] not in LEGAL:
            self.counts["illegal"] += 1
        if turn is not None and turn != self.high:
            self.low, self.high = turn if self.low is None else self.low, turn
            self.turns += 1
        self.last, self.last_role = (turn, role, mark), role
        self.edits.append(self.survivors.step(role[:1], blank or again, fault == "truncated"))

    def result(self) -> dict:
        cost, rest = self.survivors.finish()
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return {"gaps": gaps, **self.counts, "cost": cost, "audit": "".join(self.edits) + rest}


NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _conversations(batches: Iterator[pa.RecordBatch], names: list[str], open_one, add, close, columns: dict[str, pa.DataType], most: int = 20_000):
    """Walk rows sorted by conv_id: open, add every row, close; ``add`` and ``close`` give rows to send on."""
    some, now, key, kind, size = [], None, None, pa.int64(), 0

    def batch_of(rows):
        made = [pa.array([r[0] for r in rows], kind)] + [pa.array([r[1][c] for r in rows], t) for c, t in columns.items()]
        return pa.RecordBatch.from_arrays(made, names=["conv_id", *columns])

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for row in zip(*(batch.column(n).to_pylist() for n in ["conv_id", *names])):
            if now is None or row[0] != key:
                if now is not None:
                    some += [(key, r) for r in close(now)]
                key, now = row[0], open_one()
            for r in add(now, *row[1:]):
                some.append((key, r))
                size += sum(len(v) for v in r.values() if isinstance(v, str))
            if len(some) >= most or size > 1 << 24:
                yield batch_of(some)
                some, size = [], 0
    if now is not None:
        some += [(key, r) for r in close(now)]
    if some:
        yield batch_of(some)


def _clean(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and the text's mark; a null role or text is one blank."""
    rows = turns.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    return rows.withColumn("mark", F.md5(F.col("text").cast("binary")))


ORDER = ["conv_id", "turn", "role", "mark"]


def audits(turns: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit (the edits) of every conversation.

    Rows go by turn, a null turn first; equal turns by role, then by md5 of the text. Null roles and texts are one blank. Roles that do
    not begin with s, u or a must be changed or deleted. Repeated rows are duplicates; rows with a null conv_id are one conversation; an
    empty table stays empty; other columns are ignored. Texts are judged whole but not moved: only marks of them are shuffled.
    A conversation's rows pass one task, which holds its undecided edits.
    """
    rows = _clean(turns)
    body = F.rtrim("text", F.lit(BLANKS))
    rows = rows.select(*ORDER, (body == "").alias("blank"), F.substring(body, -1, 1).isin(".", "!", "?").alias("closed"))
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = rows.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("mark").alias("m")).agg(F.min(when).alias("first"))
    rows = rows.join(first.hint("merge"), rows.conv_id.eqNullSafe(first.c) & (rows.role == first.r) & (rows["mark"] == first.m))
    rows = rows.select(*ORDER, (when > F.col("first")).alias("again"), "blank", "closed")
    columns = {**dict.fromkeys(NUMBERS, pa.int64()), "audit": pa.string()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def add(now, *row):
            now.add(*row)
            return ()

        yield from _conversations(batches, ["turn", "role", "mark", "again", "blank", "closed"], _Audit, add, lambda now: [now.result()], columns)

    ordered = rows.repartition("conv_id").sortWithinPartitions(*ORDER)
    schema = rows.select("conv_id").withColumns({**{n: F.lit(0).cast("long") for n in NUMBERS}, "audit": F.lit("")}).schema
    return ordered.mapInArrow(work, schema)


class _Rows:
    """A conversation's edits, and how far they have been carried out."""

    def __init__(self):
        self.audit, self.at, self.place, self.last = "", 0, 0, ""

    def put(self, edit: str, turn, role: str, text: str) -> dict:
        self.place += 1
        self.last = role[:1]
        return {"place": self.place - 1, "turn": turn, "edit": edit, "role": role, "text": text}

    def other(self) -> str:
        return ROLES["a" if self.last == "u" else "u"]

    def inserted(self) -> Iterator[dict]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield self.put("I", None, self.other(), "")

    def add(self, audit: str | None, turn, role: str, text: str) -> Iterator[dict]:
        if audit is not None:
            self.audit = audit
            return
        yield from self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit != "D":
            yield self.put(edit, turn, self.other() if edit == "R" else role, text)


def repair(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place, turn (null where inserted), edit (K, R or I), role, text.

    ``audited`` are the ``audits`` of the same rows. Rows of a conversation come in order, one after the other.
    """
    rows = _clean(turns)
    nothing = {"turn": F.lit(None).cast(turns.schema["turn"].dataType), **{c: F.lit("") for c in ("role", "text", "mark")}}
    edits = audited.select("conv_id", *[v.alias(k) for k, v in nothing.items()], "audit", F.lit(0).alias("kind"))
    rows = edits.unionByName(rows.withColumns({"audit": F.lit(None).cast("string"), "kind": F.lit(1)}))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ORDER[1:]).select("conv_id", "audit", "turn", "role", "text")
    columns = {"place": pa.int64(), "turn": pa.int64(), "edit": pa.string(), "role": pa.string(), "text": pa.string()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _conversations(batches, ["audit", "turn", "role", "text"], _Rows, _Rows.add, lambda now: now.inserted(), columns)

    schema = turns.select("conv_id").withColumns({"place": F.lit(0).cast("long"), "turn": F.lit(0).cast("long"), **{c: F.lit("") for c in ("edit", "role", "text")}}).schema
    for field in schema:
        field.nullable = True
    return ordered.mapInArrow(work, schema)


def digests(turns: DataFrame) -> DataFrame:
    """The ``audits`` with repaired_sha256, the hash of the repaired ``role:text`` joined by newlines.

    SHA-256 runs over a conversation in order, so its texts pass one task, one after the other.
    """
    from tessera.session import cut

    audited = cut(audits(turns))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        def add(state, place, role, text):
            state.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            return ()

        yield from _conversations(batches, ["place", "role", "text"], sha256, add, lambda s: [{"hash": s.hexdigest()}], {"hash": pa.string()})

    hashes = repair(turns, audited).select("conv_id", "place", "role", "text")
    hashes = hashes.mapInArrow(work, hashes.select("conv_id", F.lit("").alias("hash")).schema).withColumnRenamed("conv_id", "of")
    made = audited.join(hashes, audited.conv_id.eqNullSafe(hashes.of), "left").drop("of")
    return made.select("conv_id", *NUMBERS, "audit", F.coalesce("hash", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def damaged(turns: DataFrame) -> DataFrame:
    """Rows spoilt by crc32 of ``conv_id:turn`` modulo 20: dropped, emptied, cut of stops, repeated, or given to the user."""
    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))))
    return rows.drop("col")


def damage_and_repair(turns: DataFrame) -> DataFrame:
    """``digests`` of the damaged rows for every conv_id; a conversation without a row left has zeros and empty texts."""
    ids = turns.select(F.col("conv_id").alias("id")).distinct()
    made = digests(damaged(turns))
    made = ids.join(made, ids.id.eqNullSafe(made.conv_id), "left").drop("conv_id")
    numbers = [F.coalesce(n, F.lit(0)).alias(n) for n in NUMBERS]
    return made.select(F.col("id").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))

"""Chat formatting with offset-aligned loss masks.

A conversation becomes one text in which control strings mark each turn's role, content and end. Control strings
inside contents are escaped, reversibly. The text is encoded once, with the characters each token covers; the loss
mask are the tokens that meet an assistant's span, found by binary search in the sorted offsets.

The control strings are special tokens, so no token reaches over the edge of a content.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
# A conversation is one output row up to this many turns by number and this many characters; longer ones go on in
# further rows (``part``), cut between turns. Control strings are hard borders, so the tokens are the same either way.
TURNS_PER_PART, CHARS_PER_PART = 1_024, 1 << 22

OUTPUT = ("conv_id bigint, segment bigint, part int, formatted string, input_ids array<int>, token_start array<int>, token_end array<int>, "
          "loss_mask array<boolean>, span_start array<int>, span_end array<int>")


def escape(text: str) -> str:
    """``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``: no control string is left."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    """Undo ``escape``: a backslash stands for the character after it."""
    if "\\" not in text:
        return text
    out, at = [], 0
    while (found := text.find("\\", at)) >= 0:
        out.append(text[at:found] + text[found + 1:found + 2])
        at = found + 2
    return "".join(out) + text[at:]


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int, str]]]:
    """The text of (role, content) turns, and each content's span and role."""
    parts, spans, size = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{SAYS}", escape(text)
        parts += [head, body, END, "\n"]
        spans.append((size + len(head), size + len(head) + len(body), role))
        size += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered text."""
    turns = []
    for piece in formatted.split(TURN)[1:]:
        role, _, rest = piece.partition(SAYS)
        turns.append((unescape(role), unescape(rest[:rest.index(END)])))
    return turns


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    import tokenizers

    tokenizer = tokenizers.Tokenizer.from_file(path)
    tokenizer.add_special_tokens([TURN, SAYS, END])
    return tokenizer


def masked(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens (sorted offsets) meet one of the sorted spans."""
    mask = np.zeros(len(starts), bool)
    for a, b in spans:
        if a < b:
            mask[bisect_right(ends, a):bisect_left(starts, b)] = True
    return mask


def masked_text(formatted: str, starts: list[int], ends: list[int], mask: list[bool]) -> list[str]:
    """The runs of text under the mask; a character cut into several tokens counts once."""
    runs: list[list[int]] = []
    for s, e, on in zip(starts, ends, mask):
        if on:
            if runs and s <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], e)
            else:
                runs.append([s, e])
    return [formatted[s:e] for s, e in runs]


def format_conversations(turns: DataFrame, tokenizer_path: str, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: text, token ids, token offsets, loss mask, loss spans (``OUTPUT``).

    ``turns`` has conv_id, turn, role, text; other columns are ignored. Turns go by number, a null number first; equal
    numbers by role and text. A null role or text is empty. Rows with a null conv_id are one conversation. Repeated
    rows are repeated turns. No rows give no conversations.

    A conversation stays whole in one task and row up to TURNS_PER_PART turn numbers and CHARS_PER_PART characters.
    Beyond that, blocks of turn numbers (``segment``) are separate keys, so one huge conversation is dealt out.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path)

        def row(key, part, held):
            formatted, spans = render(held)
            encoded = tokenizer.encode(formatted, add_special_tokens=False)
            offsets = np.array(encoded.offsets, np.int32).reshape(-1, 2)
            own = [(a, b) for a, b, role in spans if role == loss_role]
            mask = masked(offsets[:, 0], offsets[:, 1], own)
            return {"conv_id": key[0], "segment": key[1], "part": part, "formatted": formatted, "input_ids": encoded.ids,
                    "token_start": offsets[:, 0].tolist(), "token_end": offsets[:, 1].tolist(), "loss_mask": mask.tolist(),
                    "span_start": [a for a, _ in own], "span_end": [b for _, b in own]}

        def rows():
            key, part, held, size = None, 0, [], 0
            for batch in batches:
                for r in batch.to_pylist():
                    new = (r["conv_id"], r["segment"])
                    if held and (new != key or size > CHARS_PER_PART):
                        yield row(key, part, held)
                        part, held, size = (part + 1 if new == key else 0), [], 0
                    key = new
                    held.append((r["role"], r["text"]))
                    size += len(r["role"]) + len(r["text"])
            if held:
                yield row(key, part, held)

        some, tokens = [], 0
        for made in rows():
            some.append(made)
            tokens += len(made["input_ids"])
            if tokens > 200_000:
                yield pa.RecordBatch.from_pylist(some, schema=ARROW)
                some, tokens = [], 0
        if some:
            yield pa.RecordBatch.from_pylist(some, schema=ARROW)

    clean = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.floor(F.coalesce(F.col("turn"), F.lit(0)) / TURNS_PER_PART).cast("long").alias("segment"),
                         "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return clean.repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "turn", "role", "text").mapInArrow(work, OUTPUT)


ARROW = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("part", pa.int32()), ("formatted", pa.string()), ("input_ids", pa.list_(pa.int32())),
                   ("token_start", pa.list_(pa.int32())), ("token_end", pa.list_(pa.int32())), ("loss_mask", pa.list_(pa.bool_())),
                   ("span_start", pa.list_(pa.int32())), ("span_end", pa.list_(pa.int32()))])


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests per conversation, from the formatted rows alone.

    conv_id, n_turns, turns_sha256 (role, newline, text, newline per turn), loss_chars and loss_sha256 (the text under
    the loss mask, unescaped), formatted_chars. SHA-256 runs over a conversation in order, so its rows pass one task, one after
    the other; the task holds one row and two hash states.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        def rows():
            state = None
            for batch in batches:
                for r in batch.to_pylist():
                    if state is None or state["conv_id"] != r["conv_id"]:
                        if state:
                            yield state
                        state = {"conv_id": r["conv_id"], "n_turns": 0, "turns": sha256(), "loss_chars": 0, "loss": sha256(), "formatted_chars": 0}
                    for role, text in parse(r["formatted"]):
                        state["n_turns"] += 1
                        state["turns"].update(f"{role}\n{text}\n".encode())
                    for run in masked_text(r["formatted"], r["token_start"], r["token_end"], r["loss_mask"]):
                        run = unescape(run)
                        state["loss_chars"] += len(run)
                        state["loss"].update(run.encode())
                    state["formatted_chars"] += len(r["formatted"])
            if state:
                yield state

        some = []
        for s in rows():
            some.append({**{k: s[k] for k in ("conv_id", "n_turns", "loss_chars", "formatted_chars")},
                         "turns_sha256": s["turns"].hexdigest(), "loss_sha256": s["loss"].hexdigest()})
            if len(some) >= 10_000:
                yield pa.RecordBatch.from_pylist(some, schema=DIGESTS)
                some = []
        if some:
            yield pa.RecordBatch.from_pylist(some, schema=DIGESTS)

    return (formatted.select("conv_id", "segment", "part", "formatted", "token_start", "token_end", "loss_mask")
            .repartition("conv_id").sortWithinPartitions("conv_id", "segment", "part").mapInArrow(
                work, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"))


DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

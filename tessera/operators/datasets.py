"""Training and evaluation sets from tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tessera.functions.text import filled
from tessera.operators.order import dense_ids


def hash_number(*parts: Column) -> Column:
    """A repeatable number from the md5 of the joined parts (60 bits)."""
    return F.conv(F.substring(F.md5(F.concat_ws("-", *parts)), 1, 15), 16, 10).cast("bigint")


def evaluation_rows(df: DataFrame, context: str, question: str, answers: str) -> DataFrame:
    """``context, question, answers``: the first of several answers."""
    return df.select(F.col(context).alias("context"), F.col(question).alias("question"),
                     F.get(answers, F.lit(0)).alias("answers"))


def instruction_rows(df: DataFrame, template: str, slots: dict[str, str], output: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``instruction, input, output`` with an empty input."""
    text = filled(F.lit(template), {k: F.col(v) for k, v in slots.items()})
    return df.select(*keep, text.alias("instruction"), F.lit("").alias("input"), F.col(output).alias("output"))


def history_pieces(pairs: DataFrame, key: str = "conv_id", pos: str = "turn", block: int = 64) -> DataFrame:
    """Question/answer pairs of a session as JSON, at most ``block`` positions to a row.

    ``key, piece, history``: the pieces of a session in order are its whole history, so a session
    of any length is many bounded groups.
    """
    blocked = pairs.withColumn("piece", F.floor(F.col(pos) / block).cast("int"))
    packed = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.array("question", "answer").alias("qa"))))
    return blocked.groupBy(key, "piece").agg(packed.alias("h")).select(key, "piece", F.to_json("h.qa").alias("history"))


def session_rows(pairs: DataFrame, system: DataFrame, key: str = "conv_id", pos: str = "turn",
                 block: int = 64) -> DataFrame:
    """System text, last pair as instruction and output, earlier pairs as history pieces."""
    last = pairs.groupBy(key).agg(F.max(pos).alias("last"))
    marked = pairs.join(last, key)
    current = marked.filter(F.col(pos) == F.col("last")).select(
        key, F.col("question").alias("instruction"), F.col("answer").alias("output"))
    earlier = history_pieces(marked.filter(F.col(pos) < F.col("last")), key, pos, block)
    return (current.join(system, key, "left").join(earlier, key, "left")
            .select(key, F.coalesce("piece", F.lit(0)).alias("piece"), F.coalesce("system", F.lit("")).alias("system"),
                    "instruction", "output", F.coalesce("history", F.lit("[]")).alias("history")))


def message_rows(df: DataFrame, question: Column, answer: Column, image: Column, keep: tuple[str, ...],
                 marker: str = "<image>") -> DataFrame:
    """``messages`` and ``images``; the image marker leads the question."""
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    messages = F.array(turn("user", F.concat(F.lit(marker), question)), turn("assistant", answer))
    return df.select(*keep, messages.alias("messages"), F.array(image).alias("images"))


def from_messages(df: DataFrame, keep: tuple[str, ...], marker: str = "<image>") -> DataFrame:
    """Back to query, answer and image; fewer than two messages give empty texts."""
    full = F.size("messages") >= 2
    at = lambda i: F.get("messages", F.lit(i))["content"]
    return df.select(*keep, F.when(full, F.replace(at(0), F.lit(marker), F.lit(""))).otherwise("").alias("query"),
                     F.when(full, at(1)).otherwise("").alias("answer"),
                     F.coalesce(F.get("images", F.lit(0)), F.lit("")).alias("image"))


def negatives(passages: DataFrame, n: int, seed: int, key: str, text: str) -> DataFrame:
    """``n`` random other passages per row: ``key, j, neg_key, negative``; repeats are allowed. A passage alone has none.

    Rows are numbered 0..N-1 in hash order; draw j picks a number below N-1 and skips its own.
    """
    numbered = dense_ids(passages.select(key, text).withColumn("_h", F.sha2(F.col(key).cast("string"), 256)), "_h", "_id")
    total = passages.agg(F.count("*").alias("n")).scalar()
    draws = numbered.select(key, "_id", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("j"))
    drawn = F.pmod(hash_number(F.col(key), F.col("j"), F.lit(seed)), F.nullif(total - 1, F.lit(0)))
    picks = draws.withColumn("_pick", F.when(drawn >= F.col("_id"), drawn + 1).otherwise(drawn))
    others = numbered.select(F.col("_id").alias("_pick"), F.col(key).alias("neg_key"), F.col(text).alias("negative"))
    return picks.join(others, "_pick").select(key, "j", "neg_key", "negative")


def split_mark(key: Column, seed: int, test_share: float = 0.1) -> Column:
    """``test`` or ``train`` by hash; does not change with the partitioning."""
    return F.when(F.pmod(hash_number(key, F.lit(seed)), F.lit(1000)) < int(test_share * 1000), "test").otherwise("train")


THINKING_END = "</think>"


def accepted(output: Column, truth: Column) -> Column:
    """The true answer is boxed and the thinking part is closed."""
    boxed = F.concat(F.lit("boxed{"), truth, F.lit("}"))
    return F.contains(output, boxed) & F.contains(output, F.lit(THINKING_END))


def first_accepted(attempts: DataFrame, key: str, attempt: str, output: str, ok: str, rounds: int = 15) -> DataFrame:
    """First accepted attempt of every row within ``rounds``: ``key, attempt, output``."""
    good = attempts.filter(F.col(ok) & (F.col(attempt) <= rounds))
    first = good.groupBy(key).agg(F.min(F.struct(attempt, output)).alias("f"))
    return first.select(key, f"f.{attempt}", f"f.{output}")


def left_over(attempts: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return attempts.select(key).distinct().join(done.select(key), key, "left_anti")


def oversampled(df: DataFrame, times: int) -> DataFrame:
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times))))


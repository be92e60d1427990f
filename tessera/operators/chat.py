"""Session histories as rows.

A history is the earlier rows of its session; what a prompt needs of it (place, length, text) is
computed in bounded blocks, so one very long session is spread like many short ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.operators.order import running_sum


def history_rows(turns: DataFrame, key: str = "conv_id", pos: str = "turn", text: str = "text") -> DataFrame:
    """Every turn with the number of turns and characters before it."""
    sized = turns.withColumn("_one", F.lit(1)).withColumn("_chars", F.length(text))
    counted = running_sum(sized, key, pos, "_one", "_turns")
    measured = running_sum(counted, key, pos, "_chars", "_total")
    return measured.select(*turns.columns, (F.col("_turns") - 1).alias("turns_before"),
                           (F.col("_total") - F.col("_chars")).alias("chars_before"))


def with_defaults(turns: DataFrame, defaults: list[tuple[str, str]], key: str = "conv_id", pos: str = "turn") -> DataFrame:
    """Prompt rows of each session's first turn: the default turns, then the turn itself.

    Later turns have a history and get no defaults. ``key, turn, seq, role, text``.
    """
    first = turns.groupBy(key).agg(F.min(pos).alias(pos))
    shots = F.array(*[F.struct(F.lit(i).alias("seq"), F.lit(r).alias("role"), F.lit(c).alias("text"))
                      for i, (r, c) in enumerate(defaults)])
    shown = first.select(key, pos, F.inline(shots))
    own = turns.join(first, [key, pos], "left_semi").select(key, pos, F.lit(len(defaults)).alias("seq"), "role", "text")
    return shown.unionByName(own)


def history_text(turns: DataFrame, key: str = "conv_id", pos: str = "turn", block: int = 64) -> DataFrame:
    """One ``role: content`` line per turn, at most ``block`` positions to a row: ``key, piece, history``.

    The pieces of a session in order are its whole history.
    """
    lines = turns.select(key, F.floor(F.col(pos) / block).cast("int").alias("piece"), pos,
                         F.concat_ws(": ", "role", "text").alias("line"))
    packed = lines.groupBy(key, "piece").agg(F.array_sort(F.collect_list(F.struct(pos, "line"))).alias("l"))
    return packed.select(key, "piece", F.array_join("l.line", "\n").alias("history"))

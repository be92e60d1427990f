"""Combinators of Columns and DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tessera.session import cut

Step = Callable[[DataFrame], DataFrame]
Func = Callable[[Column], Column]


def chain(df: DataFrame, *steps: Step) -> DataFrame:
    for step in steps:
        df = df.transform(step)
    return df


class FanOut:
    """The same input for several functions."""

    def __init__(self, value: Column, functions: dict[str, Func]):
        self.columns = {name: f(value) for name, f in functions.items()}

    def as_struct(self) -> Column:
        return F.struct(*[c.alias(n) for n, c in self.columns.items()])

    def as_array(self) -> Column:
        return F.array(*self.columns.values())

    def as_map(self) -> Column:
        return F.create_map(*[x for n, c in self.columns.items() for x in (F.lit(n), c)])

    def joined(self, separator: str) -> Column:
        return F.concat_ws(separator, *[c.cast("string") for c in self.columns.values()])


def divert(values: list[Column], functions: list[Func]) -> Column:
    """The i-th value to the i-th function."""
    if len(values) != len(functions):
        raise ValueError("as many values as functions are needed")
    return F.array(*[f(v) for v, f in zip(values, functions)])


def each(values: Column, function: Func) -> Column:
    return F.transform(values, function)


def branch(condition: Column, yes: Column, no: Column) -> Column:
    return F.when(condition, yes).otherwise(no)


def branch_rows(df: DataFrame, condition: Column, yes: Step, no: Step) -> DataFrame:
    holds = F.coalesce(condition, F.lit(False))
    return yes(df.filter(holds)).unionByName(no(df.filter(~holds)))


def switch(cases: list[tuple[Column, Column]], default: Column) -> Column:
    """The value of the first case that holds."""
    out = default
    for condition, value in reversed(cases):
        out = F.when(condition, value).otherwise(out)
    return out


def switch_rows(df: DataFrame, cases: list[tuple[Column, Step]], default: Step) -> DataFrame:
    """Rows go to the step of their first true case."""
    number = switch([(c, F.lit(i)) for i, (c, _) in enumerate(cases)], F.lit(len(cases)))
    marked = df.withColumn("_case", number)
    out = None
    for i, step in enumerate([*(s for _, s in cases), default]):
        part = step(marked.filter(F.col("_case") == i).drop("_case"))
        out = part if out is None else out.unionByName(part)
    return out


def loop(df: DataFrame, step: Step, done: Column, max_rounds: int) -> DataFrame:
    """Repeat ``step`` on the rows that are not done, at most ``max_rounds`` times.

    Finished rows are not touched again. Adds ``rounds`` and ``done``.
    """
    stop = F.coalesce(done, F.lit(False))
    active, finished = df.withColumn("rounds", F.lit(0)), None
    for _ in range(max_rounds):
        state = cut(active.transform(step).withColumn("rounds", F.col("rounds") + 1).withColumn("done", stop))
        out = state.filter("done")
        finished = out if finished is None else finished.unionByName(out)
        active = state.filter("not done").drop("done")
        if active.isEmpty():
            return finished
    rest = active.withColumn("done", F.lit(False))
    return rest if finished is None else finished.unionByName(rest)


def intent(text: Column, rules: dict[str, list[str]], default: str) -> Column:
    """The intent with most keyword hits; ties go to the first listed, no hit to the default."""
    def hits(words: list[str]) -> Column:
        total = F.lit(0)
        for w in words:
            total = total + F.contains(F.lower(text), F.lit(w)).cast("int")
        return total

    counts = F.array(*[F.struct(hits(words).alias("n"), F.lit(-i).alias("o"), F.lit(name).alias("name"))
                       for i, (name, words) in enumerate(rules.items())])
    best = F.array_max(counts)
    return F.when(best["n"] > 0, best["name"]).otherwise(F.lit(default))

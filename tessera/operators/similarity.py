"""Registry of similarity functions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from tessera.operators.search import top_k

# What the modes read: the query's column and the node's.
INPUTS = {"text": ("text", "content"), "embedding": ("query_vec", "vec")}


@dataclass(frozen=True)
class Similarity:
    """``mode`` names the input (text or embedding), ``descending`` the order.

    Without ``batch`` the function takes two Columns; with it, the whole node and query tables.
    """

    name: str
    func: Callable
    mode: str
    descending: bool
    batch: bool

    def columns(self, df: DataFrame) -> tuple[str, str]:
        """The query and node columns that the mode reads."""
        names = INPUTS[self.mode]
        for name in names:
            kind = df.schema[name].dataType
            if isinstance(kind, T.ArrayType) != (self.mode == "embedding"):
                raise TypeError(f"{self.name} works on {self.mode}, {name} is {kind.simpleString()}")
        return names

    def score_pairs(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` with ``score``; a text function gets ``text`` and ``content``, an embedding one ``query_vec`` and ``vec``."""
        if self.batch:
            raise ValueError(f"{self.name} needs the whole group")
        query, node = self.columns(pairs)
        return pairs.withColumn("score", F.round(self.func(F.col(query), F.col(node)), 6))

    def best_pairs(self, pairs: DataFrame, by: list[str], k: int, ties: list[str]) -> DataFrame:
        """The best k pairs of every group, in the order the function is registered with."""
        return top_k(self.score_pairs(pairs), by, k, ties, descending=self.descending)

    def search(self, nodes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
        if not self.batch:
            raise ValueError(f"{self.name} scores single pairs")
        return self.func(nodes, queries, k)


class SimilarityRegistry:
    def __init__(self):
        self._known: dict[str, Similarity] = {}

    def add(self, name: str, func: Callable, mode: str = "text", descending: bool = True, batch: bool = False) -> None:
        if mode not in ("text", "embedding"):
            raise ValueError("mode is text or embedding")
        self._known[name] = Similarity(name, func, mode, descending, batch)

    def __getitem__(self, name: str) -> Similarity:
        return self._known[name]

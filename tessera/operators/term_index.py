"""Stored inverted index with segments, and BM25 search that skips what cannot reach the top k.

A commit writes one segment: its nodes, in key order within a file, cut into shelves of neighbouring nodes; a block of postings per term
and shelf, made by the task that reads the shelf (a shelf that two tasks read has two), stored by a hash of the term, with the largest count and the shortest node in it; and the nodes it removes. Segments are
never changed. The one-row ``meta`` entry is written last and makes a segment count, so a failed or repeated commit
changes nothing. ``compact`` writes all live nodes as a new base segment; older segments stay readable until ``vacuum``.

A search reads the term hashes it needs. From the small columns of the blocks it bounds what a shelf can score for a
query; the best shelves give the k-th score so far, and only shelves whose bound reaches it are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tessera.functions.text import word_counts
from tessera.operators.ranking import query_terms
from tessera.operators.search import block_search, term_scorer
from tessera.session import cut, exists, work_path

SHELF_NODES = 128  # nodes whose postings of a term make one block
FILE_NODES = 10_000  # nodes whose postings of a term hash make one file at least, if there are so many
MAX_GONE = 1_000_000  # removed nodes whose keys travel to all executors (checked)
FIRST = 4  # shelves per query that give the first k-th score
SLACK = 2e-6  # scores are rounded to six digits
META = "seg string, seq bigint, nodes bigint, words bigint"


class TermIndex:
    """Postings of nodes in the folder ``path``; ``keys`` names and types the columns that identify a node."""

    def __init__(self, spark: SparkSession, keys: str = "doc_id bigint, pos int", path: str | None = None, buckets: int = 64,
                 shelf_nodes: int = SHELF_NODES, k1: float = 1.2, b: float = 0.75):
        self.spark, self.path = spark, path or work_path(spark, "term-index")
        self.key_schema, self.keys = keys, [c.split()[0] for c in keys.split(",")]
        self.buckets, self.shelf_nodes, self.k1, self.b = buckets, shelf_nodes, k1, b
        typed = keys.replace(" ", ":", 1) if "," not in keys else ", ".join(":".join(c.split(None, 1)) for c in keys.split(","))
        self.schemas = {
            "nodes": f"{keys}, shelf bigint, dl int, terms array<struct<term:string, tf:bigint>>, seg string",
            "blocks": f"term string, shelf bigint, entries array<struct<{typed}, tf:bigint, dl:int>>, n bigint, top_tf bigint, least_dl int, seg string, bucket int",
            "gone": f"{keys}, seg string",
            "minus": "term string, df bigint, seg string, bucket int",
            "meta": META}

    # ---- segments ------------------------------------------------------------------------------

    def _table(self, name: str, live: list[str] | None = None) -> DataFrame:
        """One of the stored tables, of the ``live`` segments only."""
        schema = self.schemas[name]
        if not exists(self.spark, f"{self.path}/{name}"):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        return rows if live is None else rows.filter(F.col("seg").isin(live))

    def live(self) -> list:
        """Meta rows of the segments that count: the newest base and what came after it. One row per segment."""
        rows = sorted(self._table("meta").collect(), key=lambda r: (r.seq, r.seg[0] == "s"))
        base = max((r.seq for r in rows if r.seg[0] == "b"), default=None)
        return [r for r in rows if base is None or r.seq > base or (r.seq == base and r.seg[0] == "b")]

    def _bucket(self, term: str = "term") -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int")

    def _bucket_of(self, term: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(term)), F.lit(self.buckets)).cast("int")

    def _seq(self) -> Column:
        return F.substring("seg", 2, 18).cast("bigint")

    def _alive(self, rows: DataFrame, live: list[str]) -> DataFrame:
        """``rows`` (keys, seg) without nodes that a later segment removed."""
        gone = self._table("gone", live).groupBy(*[F.col(c).alias(f"_{c}") for c in self.keys]).agg(F.max(self._seq()).alias("_gone"))
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in self.keys]
        condition = self._seq() < F.col("_gone")
        for s in same:
            condition = condition & s
        return rows.join(self._sent(gone, self._table("gone", live)), condition, "left_anti")

    @staticmethod
    def _sent(keys: DataFrame, of: DataFrame) -> DataFrame:
        """``keys``, sent to all executors if the table ``of`` that they are from has few rows; nodes with their terms are not shuffled then."""
        return F.broadcast(keys) if of.count() <= MAX_GONE else keys

    @staticmethod
    def _unique(added: DataFrame, keys: list[str], words: str) -> DataFrame:
        """The largest word list of every key; only keys that come several times are shuffled with their words."""
        several = cut(added.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").select(*[F.col(c).alias(f"_{c}") for c in keys]))
        if several.isEmpty():
            return added.select(*keys, words)
        same = F.lit(True)
        for c in keys:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        best = added.join(several, same, "left_semi").groupBy(*keys).agg(F.max(words).alias(words))
        return added.select(*keys, words).join(several, same, "left_anti").unionByName(best)

    def nodes(self) -> DataFrame:
        """All live nodes: keys, dl, terms."""
        live = [r.seg for r in self.live()]
        return self._alive(self._table("nodes", live), live).select(*self.keys, "dl", "terms")

    def commit(self, seq: int, added: DataFrame | None = None, removed: DataFrame | None = None, words: str = "words") -> None:
        """Add nodes (keys and ``words``) and remove others; ``seq`` must grow, a number already committed does nothing.

        ``removed`` holds some or all of the key columns: every live node that agrees with a row goes. An added node replaces a
        live one of its key; of equal keys in ``added`` the one with the largest word list stays. Null words are none.
        """
        live = self.live()
        if live and live[-1].seq >= seq:
            return
        names, name = [r.seg for r in live], self.segment_name(seq)
        if added is None:
            added = self.spark.createDataFrame([], f"{self.key_schema}, {words} array<string>")
        list_of = F.coalesce(F.col(words), F.expr("cast(array() as array<string>)")).alias("w")
        fresh = self._unique(added, self.keys, words).select(*self.keys, list_of).select(*self.keys, F.size("w").alias("dl"), word_counts(F.col("w")).alias("terms"))
        stored = self._write_nodes(name, fresh)
        old = self._alive(self._table("nodes", names), names)
        ids = old.select(*self.keys, "seg")  # terms of dead nodes only are fetched afterwards
        dead = ids.join(stored.select(*self.keys), self.keys, "left_semi")
        if removed is not None:
            by = [c for c in self.keys if c in removed.columns]
            dead = dead.unionByName(ids.join(removed.select(*by), by, "left_semi"))
        lost = cut(dead.distinct().select(*[F.col(c).alias(f"_{c}") for c in ids.columns]))
        same = F.lit(True)
        for c in ids.columns:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        dead = cut(old.join(self._sent(lost, lost), same, "left_semi").select(*self.keys, "dl", "terms"))
        dead.select(*self.keys).write.mode("overwrite").parquet(f"{self.path}/gone/seg={name}")
        minus = dead.select(F.explode("terms.term").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        minus.withColumn("bucket", self._bucket()).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/minus/seg={name}")
        self._write_blocks(name, stored)
        self._finish(name, seq, stored, dead)

    def _write_nodes(self, name: str, fresh: DataFrame) -> DataFrame:
        """Store nodes, in key order within a task, with the number of their shelf."""
        at = F.monotonically_increasing_id()
        shelf = F.shiftleft(F.shiftright(at, 33), 33) + F.floor(at.bitwiseAND(F.lit((1 << 33) - 1)) / self.shelf_nodes).cast("bigint")
        ordered = fresh.sortWithinPartitions(*self.keys).withColumn("shelf", shelf)
        where = f"{self.path}/nodes/seg={name}"
        ordered.select(*self.keys, "shelf", "dl", "terms").write.mode("overwrite").option("compression", "zstd").parquet(where)
        return self._table("nodes", [name])

    def _write_blocks(self, name: str, stored: DataFrame) -> None:
        tasks = max(1, stored.count() // FILE_NODES)
        schema = ", ".join(c for c in self.schemas["blocks"].split(", ") if not c.startswith(("seg ", "bucket ")))
        blocks = stored.select(*self.keys, "shelf", "dl", "terms").coalesce(tasks).mapInArrow(_shelf_blocks(self.keys), schema)
        blocks = blocks.withColumn("bucket", self._bucket()).sortWithinPartitions("bucket", "term", "shelf")
        blocks.write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(f"{self.path}/blocks/seg={name}")

    def _finish(self, name: str, seq: int, stored: DataFrame, dead: DataFrame | None) -> None:
        size = lambda df: df.agg(F.count("*").alias("nodes"), F.coalesce(F.sum("dl"), F.lit(0)).alias("words")).first()
        plus, minus = size(stored), size(dead) if dead is not None else (0, 0)
        row = [(seq, plus[0] - minus[0], plus[1] - minus[1])]
        meta = self.spark.createDataFrame(row, "seq bigint, nodes bigint, words bigint").coalesce(1)
        meta.write.mode("overwrite").parquet(f"{self.path}/meta/seg={name}")

    @staticmethod
    def base_name(live: list) -> str:
        """Name of the base segment that would stand for the ``live`` ones."""
        return f"b{live[-1].seq:018d}"

    @staticmethod
    def segment_name(seq: int) -> str:
        return f"s{seq:018d}"

    def compact(self) -> None:
        """Write all live nodes as one base segment. Searches that have begun go on with the segments they know."""
        live = self.live()
        if len(live) < 2:
            return
        name, seq = self.base_name(live), live[-1].seq
        stored = self._write_nodes(name, self.nodes())
        self._write_blocks(name, stored)
        self._finish(name, seq, stored, None)

    def vacuum(self) -> None:
        """Delete segments that no longer count; call it when no search from before the last compaction is running."""
        live = {r.seg for r in self.live()}
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for table in fs.listStatus(root) if fs.exists(root) else []:
            for entry in fs.listStatus(table.getPath()):
                folder = entry.getPath().getName()
                if folder.startswith("seg=") and folder[4:] not in live:
                    fs.delete(entry.getPath(), True)

    # ---- search --------------------------------------------------------------------------------

    def search(self, queries: DataFrame, k: int, words: str = "words", qid: str = "qid") -> DataFrame:
        """BM25 top k over the live nodes: qid, keys, score (six digits), rk; ties by key."""
        live = self.live()
        names = [r.seg for r in live]
        n, total = sum(r.nodes for r in live), sum(r.words for r in live)
        terms = query_terms(queries, words, qid).withColumn("bucket", self._bucket())
        wanted = [r.bucket for r in terms.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
        blocks = self._table("blocks", names).filter(F.col("bucket").isin(wanted))
        minus = self._table("minus", names).filter(F.col("bucket").isin(wanted))
        counts = blocks.select("term", F.col("n").alias("df")).unionByName(minus.select("term", (-F.col("df")).alias("df")))
        df = counts.join(terms.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df")).filter("df > 0")
        idf = F.log((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1.0)
        weights = cut(terms.join(df, "term").select(qid, "bucket", "term", idf.alias("w")))
        average = max(total, 1) / max(n, 1)
        part = lambda tf, dl: F.col("w") * tf * (self.k1 + 1) / (tf + self.k1 * (1 - self.b + self.b * dl / average))
        # a shelf's blocks meet once, whatever the number of queries; the sums over their terms need no second shuffle
        known = weights.select("bucket", "term").distinct()
        small = blocks.select("bucket", "term", "seg", "shelf", "top_tf", "least_dl").join(known, ["bucket", "term"], "left_semi")
        bounds = cut(small.repartition("seg", "shelf").join(weights.drop("bucket"), "term")
                     .groupBy(qid, "seg", "shelf").agg(F.sum(part(F.col("top_tf"), F.col("least_dl"))).alias("bound")))
        pair = F.struct("term", "w").alias("p")
        asked = cut(weights.groupBy(qid).agg(F.array_sort(F.collect_list(pair)).alias("p")).select(qid, F.col("p.term").alias("terms"), F.col("p.w").alias("weights")))
        scorer = term_scorer("bm25", words="terms", counts="tfs", length="dl", k1=self.k1, b=self.b, avgdl=average)

        def scored(shelves: DataFrame) -> DataFrame:
            """Top k among the nodes of the shelves: their postings meet once, and a task scores its nodes for all queries."""
            named = cut(shelves.select("seg", "shelf").distinct())
            rows = blocks.select("bucket", "term", "seg", "shelf", "entries").join(known, ["bucket", "term"], "left_semi")
            rows = rows.join(named, ["seg", "shelf"], "left_semi").select("seg", "term", F.inline("entries"))
            counted = rows.groupBy("seg", *self.keys, "dl").agg(F.collect_list(F.struct("term", "tf")).alias("t"))
            nodes = self._alive(counted, names).select(*self.keys, "dl", F.col("t.term").alias("terms"), F.col("t.tf").alias("tfs"))
            return block_search(nodes, asked, scorer, k, self.keys, ["dl", "terms", "tfs"], qid)

        first = bounds.groupBy(qid, F.pmod(F.xxhash64("seg", "shelf"), F.lit(FIRST)).alias("_part")).agg(F.max(F.struct("bound", "seg", "shelf")).alias("s"))
        floor = scored(first.select(qid, "s.seg", "s.shelf")).filter(F.col("rk") == k).select(qid, F.col("score").alias("_floor"))
        self.open = bounds.join(floor, qid, "left").filter("_floor is null or bound >= _floor - " + str(SLACK))
        self.bounds = bounds
        return scored(cut(self.open))


def _shelf_blocks(keys: list[str]):
    """Per batch of nodes a block for every term and shelf; nothing is shuffled."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = pa.Table.from_batches([batch]).combine_chunks()
            terms = nodes["terms"].combine_chunks()
            node = pa.array(np.repeat(np.arange(len(terms)), pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False)))
            if not len(node):
                continue
            flat = terms.flatten()
            rows = nodes.select([*keys, "shelf", "dl"]).take(node).append_column("tf", flat.field("tf")).append_column("term", flat.field("term"))
            rows = rows.sort_by([(c, "ascending") for c in ("term", "shelf", *keys)]).combine_chunks()
            code, shelf = rows["term"].combine_chunks().dictionary_encode().indices.to_numpy(), rows["shelf"].to_numpy()
            start = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (shelf[1:] != shelf[:-1])]))
            size = np.diff(np.append(start, len(code)))
            parts = {c: rows[c].combine_chunks() for c in (*keys, "tf", "dl")}
            entries = pa.ListArray.from_arrays(pa.array(np.append(start, len(code)), pa.int32()), pa.StructArray.from_arrays(list(parts.values()), list(parts)))
            at = pa.array(start)
            yield pa.RecordBatch.from_arrays(
                [rows["term"].combine_chunks().take(at), rows["shelf"].combine_chunks().take(at), entries, pa.array(size, pa.int64()),
                 pa.array(np.maximum.reduceat(parts["tf"].to_numpy(), start), pa.int64()), pa.array(np.minimum.reduceat(parts["dl"].to_numpy(), start), pa.int32())],
                ["term", "shelf", "entries", "n", "top_tf", "least_dl"])

    return task

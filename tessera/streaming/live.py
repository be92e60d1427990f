"""Live index, live questions, session state and masking on streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tessera.functions.masking import masked
from tessera.operators.term_index import TermIndex
from tessera.session import cut, exists, is_folder, work_path


def run_now(df: DataFrame, each_batch: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Work through all waiting input, batch by batch."""
    return (df.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def table_stream(spark: SparkSession, path: str, bytes_per_batch: int | None = None) -> DataFrame:
    """A Parquet table, one file or a folder of files, as a stream.

    Without ``bytes_per_batch`` all files that wait make one micro-batch, so rows that belong together meet whatever files they lie in.
    """
    stream = spark.readStream.schema(spark.read.parquet(path).schema)
    if bytes_per_batch:
        stream = stream.option("maxBytesPerTrigger", bytes_per_batch)
    if is_folder(spark, path):
        return stream.parquet(path)
    folder, name = path.rsplit("/", 1)  # a stream watches folders only
    return stream.option("pathGlobFilter", name).parquet(folder)


def file_stream(spark: SparkSession, path: str, glob: str, files_per_batch: int = 1) -> DataFrame:
    """Parquet files of one pattern as a stream; the schema comes from the files there now."""
    schema = spark.read.option("pathGlobFilter", glob).parquet(path).schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", glob)
            .option("maxFilesPerTrigger", files_per_batch).parquet(path))


def newest(rows: DataFrame, order: list[str]) -> DataFrame:
    """The largest row by the columns ``order`` of every document; only documents with several rows are shuffled with their texts."""
    counts = rows.groupBy("doc_id").agg(F.count("*").alias("n"))
    several = cut(counts.filter("n > 1").select(F.col("doc_id").alias("_several")))
    same = F.col("doc_id").eqNullSafe(F.col("_several"))
    best = rows.join(several, same, "left_semi").groupBy("doc_id").agg(F.max(F.struct(*order)).alias("f")).select("doc_id", "f.*")
    return rows.select("doc_id", *order).join(several, same, "left_anti").unionByName(best)


class LiveIndex:
    """Nodes of arriving documents, one folder per batch.

    A batch writes its own folder and overwrites it when it is run again, so a retry changes
    nothing. A document that comes again replaces its older nodes (the highest batch wins); of
    two in one batch the higher ``version`` wins, then the larger row.
    """

    def __init__(self, spark: SparkSession, nodes_of: Callable[[DataFrame], DataFrame], path: str | None = None):
        self.spark, self.nodes_of, self.path = spark, nodes_of, path or work_path(spark, "live-index")

    def take(self, docs: DataFrame, batch_id: int) -> None:
        rest = [c for c in docs.columns if c != "doc_id"]
        rest.sort(key=lambda c: c != "version")
        fresh = newest(docs, rest)
        self.nodes_of(fresh).write.mode("overwrite").parquet(f"{self.path}/nodes/batch={batch_id}")
        fresh.select("doc_id").write.mode("overwrite").parquet(f"{self.path}/docs/batch={batch_id}")

    def nodes(self) -> DataFrame:
        """The nodes of every document's last batch."""
        docs = self.spark.read.parquet(f"{self.path}/docs").filter("doc_id is not null")
        last = docs.groupBy("doc_id").agg(F.max("batch").alias("batch"))
        sizes = docs.groupBy("batch").agg(F.countDistinct("doc_id").alias("n")).join(last.groupBy("batch").agg(F.count("*").alias("live")), "batch")
        whole, part = [], []  # a batch is read as it is, joined with its live documents, or not at all
        for row in sizes.collect():
            (whole if row.n == row.live else part).append(row.batch)
        nodes = self.spark.read.parquet(f"{self.path}/nodes").filter("doc_id is not null")
        kept = nodes.filter(F.col("batch").isin(whole))
        if part:
            kept = kept.unionByName(nodes.filter(F.col("batch").isin(part)).join(last, ["doc_id", "batch"], "left_semi").select(*nodes.columns))
        return kept.drop("batch")


class LiveTermIndex:
    """A term index under a stream of changes: ``doc_id, version, op`` ('put' or 'delete') and the document's columns.

    A batch is one segment of the index: nodes of new documents, and tombstones for what they replace or what leaves. Of several
    changes of a document the highest version counts, in whatever order and batch they come; at equal versions a put beats a
    delete, then the larger row. A repeated batch changes nothing. Beyond ``most_segments`` segments all are merged into one, which searches that have
    begun do not notice; so a search reads a bounded number of folders.
    """

    def __init__(self, spark: SparkSession, index: TermIndex, nodes_of: Callable[[DataFrame], DataFrame], most_segments: int = 8):
        self.spark, self.index, self.nodes_of, self.most_segments = spark, index, nodes_of, most_segments

    def versions(self, names: list[str]) -> DataFrame:
        """The highest version seen of every document."""
        where = f"{self.index.path}/versions"
        if not names or not exists(self.spark, where):
            return self.spark.createDataFrame([], "doc_id bigint, version bigint")
        seen = self.spark.read.parquet(where).filter(F.col("seg").isin(names))
        return seen.groupBy("doc_id").agg(F.max("version").alias("version"))

    def take(self, changes: DataFrame, batch_id: int) -> None:
        live = self.index.live()
        if live and live[-1].seq >= batch_id:  # the batch was finished before
            return
        names = [r.seg for r in live]
        rest = [c for c in changes.columns if c not in ("doc_id", "version", "op")]
        latest = newest(changes, ["version", "op", *rest])
        known = self.versions(names).withColumnRenamed("version", "_known")
        fresh = cut(latest.join(known, "doc_id", "left").filter("_known is null or version > _known").drop("_known"))
        fresh.select("doc_id", "version").write.mode("overwrite").parquet(f"{self.index.path}/versions/seg={self.index.segment_name(batch_id)}")
        self.index.commit(batch_id, self.nodes_of(fresh.filter("op = 'put'")), fresh.select("doc_id"))
        live = self.index.live()
        if len(live) > self.most_segments:
            merged = self.versions([r.seg for r in live])
            merged.write.mode("overwrite").parquet(f"{self.index.path}/versions/seg={self.index.base_name(live)}")
            self.index.compact()


class LiveAnswers:
    """Answers to arriving questions from the index as it is at that moment."""

    def __init__(self, spark: SparkSession, index: Callable[[], DataFrame],
                 search: Callable[[DataFrame, DataFrame], DataFrame], path: str | None = None):
        self.spark, self.index, self.search = spark, index, search
        self.path = path or work_path(spark, "live-answers")

    def take(self, questions: DataFrame, batch_id: int) -> None:
        hits = self.search(self.index(), questions)
        hits.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def answers(self) -> DataFrame:
        return self.spark.read.parquet(self.path)


class SessionTotals(StatefulProcessor):
    """Turns and characters seen so far per session; ``ttl_ms`` 0 keeps them for ever.

    Turns of one micro-batch may arrive in any order; their sizes (three numbers a turn, never the
    texts) are put in order first. The trigger limit of the source bounds a micro-batch.
    """

    def __init__(self, ttl_ms: int = 0):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "turns bigint, chars bigint", self.ttl_ms or None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        turns, chars = self.seen.get() if self.seen.exists() else (0, 0)
        sizes = [part[["conv_id", "turn"]].assign(size=part["text"].str.len()) for part in rows]
        new = pd.concat(sizes).sort_values("turn", ignore_index=True)
        before = chars + new["size"].cumsum() - new["size"]
        yield pd.DataFrame({"conv_id": new["conv_id"], "turn": new["turn"],
                            "turns_before": turns + new.index.to_numpy(), "chars_before": before})
        self.seen.update((turns + len(new), int(chars + new["size"].sum())))

    def close(self) -> None:
        pass


def session_stream(turns: DataFrame, ttl_ms: int = 0) -> DataFrame:
    """Each arriving turn with the turns and characters before it in its session.

    The state of a session is two numbers, however long it gets. Needs the RocksDB state store.
    """
    return turns.groupBy("conv_id").transformWithStateInPandas(
        statefulProcessor=SessionTotals(ttl_ms),
        outputStructType="conv_id bigint, turn bigint, turns_before bigint, chars_before bigint",
        outputMode="append", timeMode="ProcessingTime" if ttl_ms else "None")


class ResultLives(StatefulProcessor):
    """Lives of saved results: from the first save of a key until no save came for ``ttl_ms``.

    A save strictly before the expiry refreshes the result; a later one starts a new life. Saves may arrive in any order within the
    watermark's delay: lives that a late save connects become one. A timer at the expiry emits the life and takes it out of the state,
    so the state holds keys that may still be refreshed and nothing else.
    """

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lives = handle.getListState("lives", "first bigint, last bigint, saves bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = [(int(ms), int(ms), 1) for part in rows for ms in part["ms"]]
        before = [tuple(map(int, life)) for life in self.lives.get()] if self.lives.exists() else []
        merged: list[tuple[int, int, int]] = []
        for first, last, saves in sorted(before + new):
            if merged and first < merged[-1][1] + self.ttl_ms:
                merged[-1] = (merged[-1][0], max(merged[-1][1], last), merged[-1][2] + saves)
            else:
                merged.append((first, last, saves))
        self.lives.put(merged)
        due = {life[1] + self.ttl_ms for life in merged}
        for old in {life[1] + self.ttl_ms for life in before} - due:
            self.handle.deleteTimer(old)
        for when in due - {life[1] + self.ttl_ms for life in before}:
            self.handle.registerTimer(when)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        lives = [tuple(map(int, life)) for life in self.lives.get()] if self.lives.exists() else []
        over = [life for life in lives if life[1] + self.ttl_ms <= now]
        left = [life for life in lives if life[1] + self.ttl_ms > now]
        if left:
            self.lives.put(left)
        else:
            self.lives.clear()
        if over:
            yield pd.DataFrame([(key[0], first, last, saves, last + self.ttl_ms) for first, last, saves in over],
                               columns=["key", "first_ms", "last_ms", "saves", "expired_ms"])

    def close(self) -> None:
        pass


def expired_results(saves: DataFrame, key: str, at: str, ttl_ms: int, delay: str = "1 hour") -> DataFrame:
    """Stream of expiries of the stream ``saves``: key, first_ms, last_ms, saves, expired_ms (event time in milliseconds).

    ``key`` is a bigint, ``at`` a timestamp. A life is emitted once the watermark (the latest event less ``delay``) has passed its expiry.
    Needs the RocksDB state store.
    """
    rows = saves.select(F.col(key).alias("key"), F.col(at).cast("timestamp").alias("at")).filter("key is not null and at is not null")
    rows = rows.withWatermark("at", delay).withColumn("ms", F.unix_millis("at"))
    return rows.groupBy("key").transformWithStateInPandas(
        statefulProcessor=ResultLives(ttl_ms), outputStructType="key bigint, first_ms bigint, last_ms bigint, saves bigint, expired_ms bigint",
        outputMode="append", timeMode="EventTime")


class OrderedTurns(StatefulProcessor):
    """Hands on the turns of a session in their order, with the turns and characters before each.

    A turn that comes before its predecessor is held, as three numbers in the state. If the predecessor has not come ``wait_ms`` of event time
    after the held turn, the order goes on without it; should it come after all, it is numbered where it arrives.
    """

    def __init__(self, wait_ms: int):
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "next bigint, turns bigint, chars bigint")
        self.held = handle.getListState("held", "turn bigint, size bigint, ms bigint")

    def _state(self) -> tuple[list[int], list[tuple[int, int, int]]]:
        seen = list(map(int, self.seen.get())) if self.seen.exists() else [0, 0, 0]
        return seen, [tuple(map(int, h)) for h in self.held.get()] if self.held.exists() else []

    def _release(self, key, seen: list[int], held: list[tuple[int, int, int]], until: int) -> Iterator[pd.DataFrame]:
        """Hand on what is next, and all that is up to turn ``until``."""
        out, rest = [], []
        for turn, size, ms in sorted(held):
            if turn <= max(seen[0], until):
                out.append((key[0], turn, seen[1], seen[2]))
                seen[:] = [max(seen[0], turn + 1), seen[1] + 1, seen[2] + size]
            else:
                rest.append((turn, size, ms))
        self.seen.update(tuple(seen))
        if rest:
            self.held.put(rest)
            for ms in {r[2] + self.wait_ms for r in rest} - set(self.handle.listTimers()):
                self.handle.registerTimer(ms)
        elif self.held.exists():
            self.held.clear()
        if out:
            yield pd.DataFrame(out, columns=["conv_id", "turn", "turns_before", "chars_before"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seen, held = self._state()
        held += [tuple(map(int, r)) for part in rows for r in part[["turn", "size", "ms"]].itertuples(index=False)]
        yield from self._release(key, seen, held, -1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        seen, held = self._state()
        late = [turn for turn, _, ms in held if ms + self.wait_ms <= now]
        if late:
            yield from self._release(key, seen, held, max(late))

    def close(self) -> None:
        pass


def ordered_sessions(turns: DataFrame, at: str, wait_ms: int, delay: str = "1 hour") -> DataFrame:
    """Stream of ``conv_id, turn, turns_before, chars_before`` in the order of the turns, which count from 0.

    ``at`` is the event time. The state of a session is three numbers and those of the turns held; texts are not kept. Needs the RocksDB state store.
    """
    rows = turns.filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull() & F.col(at).isNotNull())
    rows = rows.select("conv_id", "turn", F.coalesce(F.length("text"), F.lit(0)).alias("size"), F.col(at).cast("timestamp").alias("at"))
    rows = rows.withWatermark("at", delay).withColumn("ms", F.unix_millis("at"))
    return rows.groupBy("conv_id").transformWithStateInPandas(
        statefulProcessor=OrderedTurns(wait_ms), outputStructType="conv_id bigint, turn bigint, turns_before bigint, chars_before bigint",
        outputMode="append", timeMode="EventTime")


def fresh_results(results: DataFrame, now: str, seconds: int) -> DataFrame:
    """Saved results that are younger than ``seconds`` at ``now``."""
    return results.filter(F.col("created_at") > F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(secs=F.lit(seconds)))


def masked_stream(texts: DataFrame, column: str, words: list[str]) -> DataFrame:
    """Stateless masking; works on batch and stream alike."""
    return texts.withColumn(column, masked(F.col(column), words))

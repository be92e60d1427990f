"""Stateful streams: expiry of saved results, turns in order."""

import os
from datetime import UTC, datetime, timedelta

import pytest

from tessera.session import work_path
from tessera.streaming import live

HOUR = 3_600_000


@pytest.fixture(scope="module", autouse=True)
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.set(key, before)


def run(spark, waves, schema, made):
    """Each wave is a file and a micro-batch of its own."""
    source, out = work_path(spark, "in"), work_path(spark, "out")
    os.makedirs(source)
    for i, wave in enumerate(waves):
        spark.createDataFrame(wave, schema).coalesce(1).write.mode("append").parquet(source)
    stream = made(live.file_stream(spark, source, "*.parquet"))
    stream.writeStream.format("parquet").option("checkpointLocation", work_path(spark, "cp")).trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out).collect()


def at(hours):
    return datetime(2024, 3, 1, tzinfo=UTC) + timedelta(hours=hours)


def test_lives_of_saved_results(spark):
    start = int(at(0).timestamp()) * 1000
    waves = [[(1, at(0)), (2, at(0)), (3, at(0)), (None, at(0)), (4, None)],
             [(1, at(9)), (2, at(10)), (3, at(20))],  # before its time; at its time; after
             [(3, at(10.5)), (3, at(9.5)), (9, at(21))],  # late, but within the delay: connects the lives of 3
             [(9, at(100))]]
    rows = run(spark, waves, "user bigint, ts timestamp", lambda s: live.expired_results(s, "user", "ts", 10 * HOUR, "12 hours"))
    got = sorted((r.key, (r.first_ms - start) / HOUR, (r.last_ms - start) / HOUR, r.saves, (r.expired_ms - start) / HOUR) for r in rows)
    assert got == [(1, 0, 9, 2, 19), (2, 0, 0, 1, 10), (2, 10, 10, 1, 20), (3, 0, 20, 4, 30), (9, 21, 21, 1, 31)]


def test_shuffled_turns_come_in_order(spark):
    turn = lambda c, n: (c, n, "x" * (n + c), at(n / 60))
    waves = [[turn(1, 3), turn(1, 1), turn(2, 0)], [turn(1, 0), turn(2, 2)], [turn(1, 2), turn(1, 4), turn(2, 1)]]
    rows = run(spark, waves, "conv_id bigint, turn bigint, text string, at timestamp", lambda s: live.ordered_sessions(s, "at", HOUR, "2 hours"))
    got = sorted((r.conv_id, r.turn, r.turns_before, r.chars_before) for r in rows)
    assert got == [(c, n, n, sum(range(n)) + c * n) for c, most in ((1, 5), (2, 3)) for n in range(most)]


def test_a_missing_turn_is_waited_for_and_then_left_out(spark):
    turn = lambda c, n, hour: (c, n, "ab", at(hour))
    waves = [[turn(1, 0, 0), turn(1, 2, 0.2), turn(1, 3, 0.3)], [turn(5, 0, 10)], [turn(6, 0, 10)], [turn(5, 1, 11), turn(1, 1, 10.5)]]
    rows = run(spark, waves, "conv_id bigint, turn bigint, text string, at timestamp", lambda s: live.ordered_sessions(s, "at", HOUR, "1 hour"))
    got = sorted((r.conv_id, r.turns_before, r.turn, r.chars_before) for r in rows)
    assert got == [(1, 0, 0, 0), (1, 1, 2, 2), (1, 2, 3, 4), (1, 3, 1, 6), (5, 0, 0, 0), (5, 1, 1, 2), (6, 0, 0, 0)]

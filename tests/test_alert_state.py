"""The stateful alert stream against windows over the whole history."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from millrace.streaming import ingest
from millrace.streaming.alert_state import alert_history, alert_stream

START = datetime(2026, 1, 1, tzinfo=timezone.utc)
SIGNAL = "fingerprint string, severity string, evaluated_at timestamp"


@pytest.fixture
def rocks(spark):
    key, value = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    yield spark
    spark.conf.set(key, before)


def signals(*rows):
    return [(f, s, START + timedelta(seconds=at)) for f, s, at in rows]


def run(spark, folder, *batches):
    """The transitions after each batch of signals, a file each, and the whole history."""
    out, cp, source = f"{folder}/out", f"{folder}/cp", f"{folder}/in"
    counts = []
    for rows in batches:
        spark.createDataFrame(rows, SIGNAL).coalesce(1).write.mode("append").parquet(source)
        stream = alert_stream(ingest.file_stream(spark, source, 1), timedelta(seconds=300), "0 seconds")
        stream.writeStream.format("parquet").option("checkpointLocation", cp).trigger(availableNow=True).start(out).awaitTermination()
        counts.append(spark.read.parquet(out).count())
    return counts, spark.read.parquet(out), spark.read.parquet(source)


def shown(df):
    return sorted((r.fingerprint, r.occurred_at, r.transition_order, r.state, r.severity, r.transition_id) for r in df.collect())


def test_states_open_change_and_time_out(rocks, tmp_path):
    counts, moves, history = run(
        rocks, tmp_path,
        signals(("a", "WARNING", 0), ("a", "WARNING", 100), ("a", "CRITICAL", 200), ("b", "WARNING", 0), ("b", "WARNING", 300)),
        signals(("a", "CRITICAL", 450), ("c", "WARNING", 460)),
        signals(("c", "WARNING", 900)),
        signals(("z", "WARNING", 5000)),
    )
    got = [(m.fingerprint, m.state, m.severity, int((m.occurred_at.replace(tzinfo=timezone.utc) - START).total_seconds())) for m in moves.collect()]
    a = [("a", "OPEN", "WARNING", 0), ("a", "RESOLVED", "WARNING", 200), ("a", "OPEN", "CRITICAL", 200), ("a", "RESOLVED", "CRITICAL", 750)]
    b = [("b", "OPEN", "WARNING", 0), ("b", "RESOLVED", "WARNING", 600)]
    c = [("c", "OPEN", "WARNING", 460), ("c", "RESOLVED", "WARNING", 760), ("c", "OPEN", "WARNING", 900), ("c", "RESOLVED", "WARNING", 1200)]
    assert sorted(got) == sorted([*a, *b, *c, ("z", "OPEN", "WARNING", 5000)])
    assert counts == sorted(counts) and counts[0] == 4
    assert shown(moves) == shown(alert_history(history, timedelta(seconds=300), F.lit(START + timedelta(seconds=5000))))


def test_the_stream_gives_what_windows_give(rocks, tmp_path):
    r = random.Random(5)
    rows = sorted(((r.choice("abcdef"), r.choice(["WARNING", "CRITICAL"]), r.randrange(0, 8000, 10)) for _ in range(150)), key=lambda x: x[2])
    rows = list({(f, at): (f, s, at) for f, s, at in rows}.values())
    rows.sort(key=lambda x: x[2])
    parts = [signals(*[x for x in rows if low <= x[2] < low + 4000]) for low in range(0, 8000, 4000)]
    _, moves, history = run(rocks, tmp_path, *parts)
    until = history.agg(F.max("evaluated_at")).first()[0].replace(tzinfo=timezone.utc)
    assert shown(moves) == shown(alert_history(history, timedelta(seconds=300), F.lit(until)))

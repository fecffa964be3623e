"""Commit observation, compacted sink logs, the event sink and settings of one machine."""

import os
import subprocess
import sys
from datetime import datetime, timezone

import pytest
from conftest import ROOT
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.sources import byte_log, record_log, tables
from millrace.streaming import commits, ingest

ONCE = {"availableNow": True}
RECORD = "topic string, partition int, offset long, timestamp timestamp, key binary, value binary"
AT = datetime(2026, 1, 1, tzinfo=timezone.utc)


def test_one_batch_of_a_compacted_log(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(12):
        spark.range(i + 1).select(F.lit("VALID").alias("validation_status"), "id").write.mode("append").parquet(source)
        q = ingest.parquet_sink(ingest.file_stream(spark, source, 100), "s", sink, str(tmp_path / "cp"), [], ONCE)
        q.awaitTermination()
    assert [(b, c) for b, c, _ in tables.commit_log(spark, sink)] == [(b, b == 9) for b in range(12)]
    for i in range(12):
        assert tables.committed_status_counts(spark, sink, i).collect() == [("VALID", i + 1)]
    assert tables.committed_status_counts(spark, sink).collect() == [("VALID", 78)]
    with pytest.raises(ValueError, match="not committed"):
        tables.committed_status_counts(spark, sink, 12)
    os.remove(f"{sink}/_spark_metadata/4")
    with pytest.raises(ValueError, match="is gone"):
        tables.committed_status_counts(spark, sink, 9)


@pytest.fixture
def flow(spark, tmp_path):
    """Steps that append offsets to a stored log and run both sinks; rows with an offset divisible by 5 are INVALID."""
    log, sinks, checkpoints = str(tmp_path / "log"), {}, {}
    for name in commits.ROUTES:
        sinks[name], checkpoints[name] = str(tmp_path / name), str(tmp_path / f"cp-{name}")
    state = F.when(F.col("kafka_offset") % 5 == 0, "INVALID").when(F.col("kafka_offset") % 5 == 1, "WARNING").otherwise("VALID")

    def step(*records, only=tuple(commits.ROUTES), odd=None):
        rows = [("t", p, o, AT, None, f"{p}-{o}".encode()) for p, o in records]
        if rows:
            record_log.append_records(spark.createDataFrame(rows, RECORD), log)
        stream = record_log.record_log(spark, log).withColumn("validation_status", odd if odd is not None else state)
        for name in only:
            df = stream.filter(F.col("validation_status").isin(*commits.ROUTES[name])) if odd is None else stream
            ingest.parquet_sink(df, name, sinks[name], checkpoints[name], [], ONCE).awaitTermination()

    return step, sinks, checkpoints


def seen(df):
    return {r.batch_id: (r.input_rows, r.VALID, r.WARNING, r.INVALID, r.problem) for r in df.collect()}


def test_batches_are_observed_once_both_sinks_have_them(spark, flow):
    step, sinks, checkpoints = flow
    assert commits.observe(spark, sinks, checkpoints).count() == 0 if os.path.exists(checkpoints["bronze"]) else True
    step(*[(0, i) for i in range(7)], (1, 0))
    step((0, 7), (2, 0), (2, 1), only=["bronze"])
    assert seen(commits.observe(spark, sinks, checkpoints)) == {0: (8, 3, 2, 3, None)}
    step(only=["dlq"])
    assert seen(commits.observe(spark, sinks, checkpoints)) == {0: (8, 3, 2, 3, None), 1: (3, 1, 1, 1, None)}
    assert set(seen(commits.observe(spark, sinks, checkpoints, after=0))) == {1}


def test_batches_that_do_not_add_up_are_named(spark, flow):
    step, sinks, checkpoints = flow
    step((0, 0), (0, 1))
    step((0, 2), (0, 3), odd=F.lit("FINE"))
    step((0, 4), only=["bronze"])
    step((0, 5))
    got = seen(commits.observe(spark, sinks, checkpoints))
    assert got[0][4] is None and got[1][4] == "unexpected status" and got[2][4] == "sinks have other offsets"
    # a committed file is lost: the offsets say more than the rows
    for name in os.listdir(sinks["dlq"]):
        if name.endswith(".parquet"):
            spark.createDataFrame([], spark.read.parquet(f"{sinks['dlq']}/{name}").schema).coalesce(1)
    events = commits.commit_events(commits.observe(spark, sinks, checkpoints), "c", "r", "t")
    assert {r.dimensions["batch_id"] for r in events.collect()} == {"0"}


def test_a_regressed_or_lost_partition_fails(spark, tmp_path):
    folder = tmp_path / "cp" / "offsets"
    os.makedirs(folder)

    def write(*texts):
        for i, text in enumerate(texts):
            (folder / str(i)).write_text(f"v1\n{{}}\n{text}\n")
        return commits.batch_ranges(spark, str(tmp_path / "cp"))

    assert sorted(map(tuple, write('{"t":{"0":3}}', '{"t":{"0":5,"1":2}}').collect())) == [(0, "t", 0, 0, 3), (1, "t", 0, 3, 5), (1, "t", 1, 0, 2)]
    with pytest.raises(PySparkException, match="regressed"):
        write('{"t":{"0":3}}', '{"t":{"0":2}}').collect()
    with pytest.raises(PySparkException, match="vanished"):
        write('{"t":{"0":3,"1":1}}', '{"t":{"0":5}}').collect()
    os.remove(folder / "0")
    (folder / "2").write_text('v1\n{}\n{"t":{"0":9}}\n')
    assert [tuple(r) for r in commits.batch_ranges(spark, str(tmp_path / "cp")).collect()] == [(2, "t", 0, 5, 9)]


def test_events_are_retried_until_all_are_out(spark, flow, tmp_path, monkeypatch):
    step, sinks, checkpoints = flow
    step((0, 0), (0, 1))
    step((0, 2))
    path = str(tmp_path / "events")

    def publish(durations):
        rows = spark.createDataFrame(durations, "batch_id long, duration_ms long")
        return commits.publish_commits(commits.commit_events(commits.observe(spark, sinks, checkpoints), "c", "r", "t", rows), path)

    real = byte_log.write_events
    monkeypatch.setattr(commits, "write_events", lambda *_: (_ for _ in ()).throw(OSError("full")))
    with pytest.raises(OSError):
        publish([(0, 900)])
    assert byte_log.read_events(spark, path).count() == 0
    monkeypatch.setattr(commits, "write_events", real)
    assert publish([(0, 900)]) == 5  # the duration of batch 1 is not known yet
    assert publish([(0, 900), (1, 100)]) == 1 and publish([(0, 900), (1, 100)]) == 0
    events = byte_log.read_events(spark, path)
    assert events.groupBy("metric_name").count().collect() and events.count() == 6
    assert {r.metric_name: r.n for r in events.groupBy("metric_name").agg(F.count("*").alias("n")).collect()} == {"quality_counts": 2, "batch_duration": 2, "last_committed": 2}


def test_bad_events_and_aborted_tasks_leave_no_line(spark, tmp_path):
    path = str(tmp_path / "events")
    good = spark.range(50).select(
        F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(F.col("id").cast("string"), 12, "0")).alias("event_id"), F.lit(AT).alias("event_time"),
        F.lit(AT).alias("observed_at"), F.lit("c").alias("component"), F.lit("m").alias("metric_name"), F.lit("delta").alias("metric_semantics"),
        F.lit("OK").alias("status"), F.lit(None).cast("string").alias("run_id"), F.create_map(F.lit("n"), F.col("id").cast("double")).alias("values"),
        F.create_map(F.lit("k"), F.lit("v")).alias("dimensions"), F.lit("v1").alias("schema_version"), "id",
    ).repartition(4)
    byte_log.write_events(good.filter("id < 10"), path)
    odd = {
        "values must be finite": ("values", F.create_map(F.lit("n"), F.lit(float("nan")))), "no UUID": ("event_id", F.lit("x")),
        "unknown semantics": ("metric_semantics", F.lit("sum")), "blank": ("component", F.lit(" ")), "no values": ("values", F.expr("cast(map() as map<string,double>)")),
    }
    for message, (column, value) in odd.items():
        with pytest.raises(PySparkException, match=message):
            byte_log.write_events(good.withColumn(column, F.when(F.col("id") == 40, value).otherwise(F.col(column))), path)
    fails = F.when(F.col("id") == 40, F.raise_error(F.lit("task lost")).cast("string")).otherwise(F.col("schema_version"))
    with pytest.raises(PySparkException, match="task lost"):
        byte_log.write_events(good.withColumn("schema_version", fails), path)
    assert byte_log.read_events(spark, path).count() == 10 and spark.read.text(path).count() == 10


def test_intermediate_tables_without_any_setting(tmp_path):
    """In a process of its own, whose Spark has no defaults of this machine."""
    code = """
from pyspark.sql import SparkSession
from millrace.plans.staging import Scratch, shared_folder
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert Scratch(spark, "x").write(spark.range(3), "y").count() == 3 and shared_folder(spark) == shared_folder(spark)
print("fine")
"""
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": ROOT}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=180)
    assert "fine" in done.stdout, done.stderr[-2000:]

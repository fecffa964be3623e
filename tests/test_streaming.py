import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from millrace.functions.commerce_contract import COMMERCE, PAID
from millrace.operators import metrics, normalize, reconcile
from millrace.operators.contract import validate_json
from millrace.plans.pipeline import Pipeline, Step, publish_gates, star_schema
from millrace.plans.publish import VersionedTables
from millrace.sources import tables
from millrace.sources.byte_log import byte_log, metric_events
from millrace.sources.generator import as_log, commerce_events
from millrace.streaming import ingest
from millrace.streaming.progress import CommitListener, append_events, batch_events, run_events

ONCE = {"availableNow": True}


@pytest.fixture
def log(spark, tmp_path):
    path = str(tmp_path / "log")
    as_log(commerce_events(spark, 300)).write.parquet(path)
    return path


def read_log(spark, path):
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def test_medallion_flow(spark, tmp_path, log):
    p = {n: str(tmp_path / n) for n in ("bronze", "dlq", "silver", "staging", "gold", "cp")}

    def land():
        for q in ingest.start_ingest(read_log(spark, log), COMMERCE, p["bronze"], p["dlq"], p["cp"], ONCE):
            q.awaitTermination()

    land()
    bronze, dlq, source = spark.read.parquet(p["bronze"]), spark.read.parquet(p["dlq"]), spark.read.parquet(log)
    assert bronze.count() + dlq.count() == 300 and dlq.count() > 0
    both = bronze.select(*normalize.LINEAGE, "raw_payload").unionByName(dlq.select(*normalize.LINEAGE, "raw_payload"))
    row = reconcile.reconcile(source, both, normalize.LINEAGE, ["raw_payload"]).first()
    assert (row.matched, row.missing, row.extra, row.mismatched) == (300, 0, 0, 0)

    files = tables.data_files(spark, p["bronze"])
    before = files.cache()
    n_files = before.count()
    land()  # no input: nothing is written again
    assert tables.data_files(spark, p["bronze"]).count() == n_files
    committed = tables.committed_files(spark, p["bronze"])
    assert committed.count() == n_files and not committed.filter("compact").count()

    ingest.silver_increment(spark, p["bronze"], p["silver"], p["cp"] + "/silver")
    assert spark.read.parquet(p["silver"]).count() == bronze.count()
    as_log(commerce_events(spark, 40, seed=7), topic="more").write.mode("append").parquet(log)
    land()
    assert tables.new_files(before, tables.data_files(spark, p["bronze"])).count() > 0
    ingest.silver_increment(spark, p["bronze"], p["silver"], p["cp"] + "/silver")
    silver = spark.read.parquet(p["silver"])
    assert silver.count() == spark.read.parquet(p["bronze"]).count()

    ingest.staging_increment(spark, p["silver"], p["staging"], p["cp"] + "/staging")
    staged = spark.read.parquet(p["staging"]).drop("batch")
    assert staged.count() == silver.count()
    store = VersionedTables(spark, p["gold"])
    star = star_schema(staged)
    version = store.publish(star, publish_gates(staged))
    assert store.read("fact_ecommerce_event").count() == staged.count() and store.current() == version
    twisted = staged.limit(1).withColumn("silver_row_hash", F.lit("0" * 64))
    conflicted = staged.unionByName(twisted)
    with pytest.raises(ValueError, match="no_conflicts"):
        store.publish(star_schema(conflicted), publish_gates(conflicted))
    assert store.current() == version


def test_staging_gate_rejects_repeats(spark, log):
    rows = validate_json(spark.read.parquet(log), COMMERCE).withColumn("ingest_date", F.current_date())
    silver = normalize.to_silver(rows)
    assert ingest.gated_silver(silver) is silver
    with pytest.raises(ValueError, match="repeated_lineage"):
        ingest.gated_silver(silver.unionByName(silver))


def test_serving_replay_changes_nothing(spark, tmp_path, log):
    measures = ["events_total", "valid_count", "warning_count", "invalid_count", "record_count", "quantity_sum", "gross_item_value"]
    store = ingest.ServingStore(spark, str(tmp_path / "serve"), "ingest_minute", measures, ["kafka_timestamp", "kafka_offset"], 100)

    def minutes(batch):
        return metrics.commerce_minutes(validate_json(batch, COMMERCE), PAID)

    def newest(batch):
        return batch.select("kafka_timestamp", "kafka_offset", "kafka_partition")

    q = ingest.start_serving(read_log(spark, log), store, minutes, newest, str(tmp_path / "cp"), ONCE)
    q.awaitTermination()
    whole = spark.read.parquet(log)
    assert store.summary().first().events_total == 300 and store.latest().count() == 100
    store.apply(minutes(whole), newest(whole), 0)
    assert store.summary().first().events_total == 300 and store.latest().count() == 100
    expected = minutes(whole).select("ingest_minute", *measures)
    row = reconcile.reconcile(expected, store.minutes(), ["ingest_minute"], measures, {"gross_item_value": 0.001}).first()
    assert row.mismatched == row.missing == row.extra == 0


def test_byte_log_defers_partial_tails(spark, tmp_path):
    path, out, cp = tmp_path / "events.jsonl", str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        q = byte_log(spark, str(tmp_path / "*.jsonl")).writeStream.format("parquet").option("path", out)
        q.option("checkpointLocation", cp).trigger(**ONCE).start().awaitTermination()
        return sorted(r.line for r in spark.read.parquet(out).collect())

    path.write_text('{"a": 1}\n{"a": 2}\n{"a"')
    assert run() == ['{"a": 1}', '{"a": 2}']
    with open(path, "a") as f:
        f.write(': 3}\n')
    assert run() == ['{"a": 1}', '{"a": 2}', '{"a": 3}']
    assert run() == ['{"a": 1}', '{"a": 2}', '{"a": 3}']
    path.write_text('{"b": 1}\n')
    with pytest.raises(StreamingQueryException, match="truncated|replaced"):
        run()


def test_metric_lines(spark, tmp_path):
    good = batch_events("kafka_to_bronze_dlq", 3, {"VALID": 5, "INVALID": 1}, 900, 1_767_225_600_000, "r")
    assert append_events(str(tmp_path / "m.jsonl"), good) and not append_events(str(tmp_path / "no/such/folder"), good)
    assert [e["event_id"] for e in good] == [e["event_id"] for e in batch_events("kafka_to_bronze_dlq", 3, {"VALID": 5, "INVALID": 1}, 900, 1_767_225_600_000, "r")]
    bad = [good[0] | {"status": "?"}, good[0] | {"event_id": "x"}, good[0] | {"extra": 1}, good[0] | {"values": {}}, good[0] | {"event_time": "2026-01-01T00:00:00"}]
    lines = [("m.jsonl", json.dumps(e)) for e in [*good, *bad]] + [("m.jsonl", "not json")]
    df = spark.createDataFrame([(s, x, "h") for s, x in lines], "source string, line string, line_sha256 string")
    registry = tmp_path / "q.json"
    registry.write_text(json.dumps({"schema_version": "monitoring-quarantine-v1", "entries": [{"source": "m.jsonl", "reason": "known", "event_ids": {"one": good[1]["event_id"]}}]}))
    accepted, rejected = metric_events(df, tables.quarantine_registry(spark, str(registry)))
    assert accepted.count() == 2
    reasons = sorted(r.reason for r in rejected.collect())
    assert reasons == sorted(["known", "unknown status", "event_id is no UUID", "unexpected fields", "no values", "times need an offset", "not a JSON object"])
    assert run_events("s", {"input_rows": 5, "non_empty_batches": 1, "last_batch_id": 0}, 5, 0, "r", __import__("datetime").datetime.now(__import__("datetime").timezone.utc))[1]["values"]["rows_per_second"] == 0.0


def test_offsets(spark, tmp_path):
    folder = tmp_path / "cp" / "offsets"
    os.makedirs(folder)
    for i, offsets in enumerate(({"t": {"0": 3, "1": 4}}, {"t": {"0": 5, "1": 4, "2": 1}})):
        (folder / str(i)).write_text("v1\n" + json.dumps({"batchWatermarkMs": 0}) + "\n" + json.dumps(offsets) + "\n")
    got = tables.checkpoint_offsets(spark, str(tmp_path / "cp"))
    old, new = got.filter("batch_id = 0"), got.filter("batch_id = 1")
    ranges = tables.offset_ranges(old, new)
    assert sorted((r.partition, r.low, r.high) for r in ranges.collect()) == [(0, 3, 5), (1, 4, 4), (2, 0, 1)]
    with pytest.raises(Exception, match="vanished|regressed"):
        tables.offset_ranges(new, old).collect()
    rows = spark.createDataFrame([("t", 0, 2), ("t", 0, 3), ("t", 0, 5), ("t", 2, 0)], "kafka_topic string, kafka_partition int, kafka_offset long")
    assert sorted((r.kafka_partition, r.kafka_offset) for r in tables.in_ranges(rows, ranges).collect()) == [(0, 3), (2, 0)]
    total = spark.range(1).select(tables.offset_total(F.lit('{"t": {"0": 3, "1": 4}}'))).first()[0]
    assert total == 7


def test_listener_pairs_batches(spark, tmp_path, log):
    listener = CommitListener()
    spark.streams.addListener(listener)
    try:
        for q in ingest.start_ingest(read_log(spark, log), COMMERCE, str(tmp_path / "b"), str(tmp_path / "d"), str(tmp_path / "c"), ONCE):
            q.awaitTermination()
        for _ in range(50):
            if listener.paired("bronze", "dlq"):
                break
            __import__("time").sleep(0.2)
        paired = listener.paired("bronze", "dlq")
        assert 0 in paired and paired[0]["bronze"]["rows"] == 300
        assert listener.totals("bronze")["input_rows"] == 300
    finally:
        spark.streams.removeListener(listener)


def test_pipeline_stops_at_a_failed_gate():
    seen = []

    def flaky(_):
        seen.append(1)
        if len(seen) == 1:
            raise OSError("once")
        return 1

    def gate(results):
        raise ValueError(f"gate after {results['a']}")

    pipeline = Pipeline([Step("a", flaky), Step("gate", gate, retries=0), Step("never", flaky)])
    with pytest.raises(RuntimeError, match="step gate failed"):
        pipeline.execute()
    assert pipeline.done == ["a"] and len(seen) == 2


def test_statements(spark):
    out = tables.statements(spark, "create or replace temp view v as select ';' as x; select * from v;")
    assert out[-1].first().x == ";"


def test_folded_batches_are_not_applied_again(spark, tmp_path):
    store = ingest.ServingStore(spark, str(tmp_path / "store"), "k", ["n"], ["at"], latest_rows=2)
    batch = lambda *rows: spark.createDataFrame(list(rows), "k string, n long, at int")

    def state():
        return {r.k: r.n for r in store.minutes().collect()}, sorted(r.at for r in store.latest().collect()), store.summary().first().n

    for i in range(4):
        store.apply(batch(("a", 1, i), (f"b{i}", 2, i)).select("k", "n"), batch(("a", 1, i)), i)
    before = state()
    store.compact(1)
    assert state() == before and store.folded() == 1
    store.apply(batch(("a", 50, 9)).select("k", "n"), batch(("a", 50, 9)), 1)  # a replay of a folded batch
    store.compact(0)
    assert state() == before
    store.compact(3)
    assert state() == before and store.folded() == 3
    store.apply(batch(("a", 1, 4)).select("k", "n"), batch(("a", 1, 4)), 4)
    assert state()[0]["a"] == before[0]["a"] + 1


@pytest.mark.parametrize("step", ["pointer", "rename"])
def test_a_crash_before_the_pointer_moves_leaves_the_old_version(spark, tmp_path, step):
    store = VersionedTables(spark, str(tmp_path / "versions"))
    store.publish({"t": spark.range(3)}, version="one")

    def crash(at):
        if at == step:
            raise OSError("lost")

    with pytest.raises(OSError):
        store.publish({"t": spark.range(5)}, version="two", before=crash)
    assert store.current() == "one" and store.read("t").count() == 3
    store.publish({"t": spark.range(5)}, version="two")
    assert store.current() == "two" and store.read("t").count() == 5


def test_minutes_expire_and_folds_are_replaced(spark, tmp_path):
    store = ingest.ServingStore(spark, str(tmp_path / "store"), "minute", ["n"], ["at"], latest_rows=2, retention=60)
    minute = lambda m: f"2026010{1 + m // 1440}{m % 1440 // 60:02d}{m % 60:02d}"

    def apply(batch, *minutes):
        rows = spark.createDataFrame([(minute(m), 1, m) for m in minutes], "minute string, n long, at int")
        store.apply(rows.groupBy("minute").agg(F.sum("n").alias("n")), rows, batch)

    def state():
        health = store.health().first()
        return {r.minute: r.n for r in store.minutes().collect()}, store.summary().first().n, health.last_batch_id, health.last_input_rows, health.last_minute_buckets

    apply(0, 0, 1, 1, 50)
    assert state() == ({minute(0): 1, minute(1): 2, minute(50): 1}, 4, 0, 4, 3) and store.has_marker(0) and not store.has_marker(1)
    apply(1, 61)
    shown = {minute(1): 2, minute(50): 1, minute(61): 1}
    assert state() == (shown, 5, 1, 1, 1)
    store.compact(0)
    apply(2)  # a batch without rows leaves the health as it is
    assert state() == (shown, 5, 1, 1, 1)
    store.compact(1)
    assert state() == (shown, 5, 1, 1, 1) and store.folds() == [0, 1] and store.has_marker(1)
    apply(1, 61, 61)  # replays of folded batches, one of which has expired in part
    apply(0, 0)
    assert state() == (shown, 5, 1, 1, 1)
    apply(3, 1500)
    apply(4, 0)  # far too late for its minute, not for the sums
    assert state() == ({minute(1500): 1}, 7, 4, 1, 1)
    store.compact(4)
    assert state() == ({minute(1500): 1}, 7, 4, 1, 1) and store.folds() == [1, 4]
    assert spark.read.parquet(str(tmp_path / "store" / "folds" / "4" / "minutes")).count() == 1
    assert sorted(p.name for p in (tmp_path / "store" / "minutes").glob("batch=*")) == ["batch=2", "batch=3", "batch=4"]
    assert store.latest().count() == 2

import json
import math
import os
import random
import shutil
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators import alerts, metrics
from millrace.plans.monitoring import MonitoringStore, StaleState
from millrace.plans.publish import TornVersion, VersionedTables
from millrace.sources.files import lines_ending_in, matching

SCHEMA = (
    "event_id string, event_time timestamp, observed_at timestamp, component string, metric_name string, metric_semantics string, "
    "status string, run_id string, `values` map<string,double>, dimensions map<string,string>, schema_version string"
)
NOW = datetime(2026, 1, 1, 4, 10, tzinfo=timezone.utc)
INGEST = "kafka_to_bronze_dlq"


def event(i, at, component, metric, kind, values, status="OK", run="r", seen=0, **dims):
    when = datetime(2026, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=at)
    values = {k: float(v) for k, v in values.items()}
    return (str(i), when, when + timedelta(seconds=seen), component, metric, kind, status, run, values, dims, "v1")


def frame(spark, *events):
    return spark.createDataFrame(list(events), SCHEMA)


T = 4 * 3600


def test_windows(spark):
    counts = ("producer", "delivery_counts", "delta")
    events = frame(
        spark,
        event("a", T + 299, *counts, {"attempted": 20}), event("a", T + 299, *counts, {"attempted": 20}, seen=9),
        event("b", T + 10, *counts, {"attempted": 3}), event("c", T + 300, *counts, {"attempted": 5}),
        event("d", T + 1, INGEST, "batch_duration", "gauge", {"duration_ms": 100}),
        event("e", T + 2, INGEST, "batch_duration", "gauge", {"duration_ms": 300}, status="WARNING"),
        event("f", T + 1, "bronze_to_silver_incremental", "checkpoint_progress", "gauge", {"last_batch_id": 8}),
        event("g", T + 2, "bronze_to_silver_incremental", "checkpoint_progress", "gauge", {"last_batch_id": 7}),
        event("h", T + 1, "x", "total", "cumulative", {"n": 100}), event("i", T + 3, "x", "total", "cumulative", {"n": 101}, status="WARNING"),
    )
    got = {(r.window_start.minute, r.metric_name): r for r in metrics.metric_windows(metrics.dedup_events(events)).collect()}
    assert got[0, "delivery_counts"]["values"] == {"attempted": 23.0} and got[5, "delivery_counts"].event_count == 1
    duration = got[0, "batch_duration"]
    assert duration["values"] == {"duration_ms": 300.0} and duration.statistics == {"duration_ms_avg": 200.0, "duration_ms_max": 300.0}
    assert got[0, "checkpoint_progress"]["values"] == {"last_batch_id": 8.0}
    assert got[0, "total"]["values"] == {"n": 101.0} and got[0, "total"].status_counts == {"OK": 1, "WARNING": 1}


def test_p95_from_twenty(spark):
    def durations(n):
        return frame(spark, *[event(i, T + i, INGEST, "batch_duration", "gauge", {"duration_ms": i + 1}) for i in range(n)])

    assert metrics.metric_windows(durations(20)).first().statistics["duration_ms_p95"] == 19.0
    assert "duration_ms_p95" not in metrics.metric_windows(durations(19)).first().statistics
    assert metrics.metric_windows(durations(1).limit(0)).count() == 0


def test_sums_of_any_size_do_not_depend_on_order(spark):
    r = random.Random(2)
    values = [r.uniform(-1, 1) * 10.0 ** r.randrange(-24, 24) for _ in range(300)] + [0.0, 1e-12, 1e-12, 1e-12]
    got = set()
    for parts in (1, 3, 8):
        r.shuffle(values)
        got.add(spark.createDataFrame([(v,) for v in values], "v double").repartition(parts).agg(metrics.steady_sum(F.col("v"))).first()[0])
    assert len(got) == 1 and abs(got.pop() - math.fsum(values)) <= 1e-15 * max(map(abs, values))
    one = lambda *v: spark.createDataFrame([(x,) for x in v], "v double").agg(metrics.steady_sum(F.col("v"))).first()[0]
    assert math.isclose(one(1e-12, 1e-12, 1e-12), 3e-12, rel_tol=1e-15) and one(1e30, 1e30) == 2e30 and one(0.1, 0.2) == math.fsum([0.1, 0.2])
    assert one(0.0) == 0.0


def test_conflict_and_drift_fail(spark):
    a, b = event("a", T, "x", "m", "delta", {"n": 1}), event("a", T, "x", "m", "delta", {"n": 2})
    with pytest.raises(PySparkException, match="conflicting payload"):
        metrics.dedup_events(frame(spark, a, b)).collect()
    with pytest.raises(PySparkException, match="inconsistent semantics"):
        metrics.metric_windows(frame(spark, a, event("b", T, "x", "m", "gauge", {"n": 2}))).collect()
    with pytest.raises(PySparkException, match="inconsistent semantics"):
        metrics.metric_windows(frame(spark, a, event("b", T, "x", "m", "delta", {"k": 2}))).collect()


def names(df):
    return {(r.alert_name, r.severity) for r in df.collect()}


@pytest.mark.parametrize(("age", "severity"), [(75, None), (76, "WARNING"), (300, "WARNING"), (301, "CRITICAL")])
def test_freshness(spark, age, severity):
    at = NOW - timedelta(seconds=age)
    seconds = (at - datetime(2026, 1, 1, tzinfo=timezone.utc)).total_seconds()
    got = names(alerts.evaluate(frame(spark, event("p", seconds, "producer", "delivery_counts", "delta", {"attempted": 5, "acknowledged": 5})), NOW))
    assert got == ({("bronze_freshness", severity)} if severity else set())


def test_rates_durations_gaps_and_mismatch(spark):
    def quality(n, invalid):
        return [event(f"q{i}", T + i, INGEST, "quality_counts", "delta", {"batch_input_rows": 20, "invalid_count": invalid}, batch_id=str(i)) for i in range(n)]

    assert names(alerts.evaluate(frame(spark, *quality(4, 6)), NOW)) == set()
    assert names(alerts.evaluate(frame(spark, *quality(5, 6)), NOW)) == {("bronze_invalid_rate", "WARNING")}
    slow = [event(f"d{i}", T + i, INGEST, "batch_duration", "gauge", {"duration_ms": 26_000}, batch_id=str(i)) for i in range(3)]
    assert names(alerts.evaluate(frame(spark, *quality(3, 0), *slow), NOW)) == {("bronze_batch_duration", "WARNING")}
    assert names(alerts.evaluate(frame(spark, *slow), NOW)) == set()
    off = event("s", T, "bronze_to_silver_incremental", "run_counts", "delta", {"input_rows": 18, "output_rows": 17})
    gap = event("p", T + 599, "producer", "delivery_counts", "delta", {"attempted": 5, "acknowledged": 4}, topic="t")
    assert names(alerts.evaluate(frame(spark, off, gap), NOW)) == {("bronze_silver_row_mismatch", "CRITICAL"), ("producer_delivery_gap", "CRITICAL")}


def test_escalation_resolves_then_opens(spark):
    off = event("s", T, "bronze_to_silver_incremental", "run_counts", "delta", {"input_rows": 18, "output_rows": 17})
    active = alerts.evaluate(frame(spark, off), NOW)
    assert alerts.transitions(active, active, NOW).count() == 0
    low = active.selectExpr("* except (severity)", "'WARNING' as severity")
    moved = alerts.transitions(low, active, NOW).orderBy("transition_order").collect()
    assert [(r.state, r.severity) for r in moved] == [("RESOLVED", "WARNING"), ("OPEN", "CRITICAL")]
    assert len({r.transition_id for r in moved}) == 2
    again = alerts.transitions(low, active, NOW).collect()
    assert {r.transition_id for r in again} == {r.transition_id for r in moved}


REJECTED = "source string, event_id string, reason string, line_sha256 string"
MISMATCH = ("bronze_to_silver_incremental", "run_counts", "delta")


def same_rows(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def test_a_crashed_pass_is_repeated(spark, tmp_path):
    store = MonitoringStore(spark, str(tmp_path / "monitor"))
    rejected = spark.createDataFrame([], REJECTED)
    first = frame(spark, event("s", T, *MISMATCH, {"input_rows": 18, "output_rows": 17}))
    changed, state = store.collect(first, rejected, NOW)
    assert changed and state.number == 1 and store.read("transitions").count() == 1
    assert store.collect(first, rejected, NOW) == (False, state)
    # the attempt that crashes has an event of another hour, which the one that succeeds lacks
    more = [event("t", T + 60, *MISMATCH, {"input_rows": 5, "output_rows": 5}), event("u", T + 90_000, *MISMATCH, {"input_rows": 5, "output_rows": 5})]
    for step in ("windows", "pointer"):

        def crash(at, step=step):
            if at == step:
                raise OSError("lost")

        with pytest.raises(OSError):
            store.collect(frame(spark, *more), rejected, NOW, before=crash)
        assert store.state() == state and store.read("journal").count() == 1 and store.read("windows").count() == 1
        assert store.load()["windows"].count() == 1
    assert store.collect(frame(spark, more[0]), rejected, NOW)[0]
    assert store.read("journal").count() == 2 and store.read("windows").count() == 1 and store.read("active").count() == 0
    assert [r.state for r in store.read("transitions").orderBy("state").collect()] == ["OPEN", "RESOLVED"]
    assert store.load()["windows"].first().event_count == 2


def test_late_events_correct_old_windows_and_touch_no_others(spark, tmp_path):
    store, rejected = MonitoringStore(spark, str(tmp_path / "monitor"), span="yyyyMMddHH"), spark.createDataFrame([], REJECTED)
    counts = ("producer", "delivery_counts", "delta")
    hours = [event(f"h{i}", i * 3600 + 20, *counts, {"attempted": i}) for i in range(5)]
    store.collect(frame(spark, *hours), rejected, NOW)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "monitor" / "windows").rglob("*.parquet")}
    late = [event("late", 3600 + 30, *counts, {"attempted": 100}), hours[3], event("h2", 2 * 3600 + 20, *counts, {"attempted": 2}, seen=50)]
    changed, state = store.collect(frame(spark, *late), rejected, NOW)
    assert changed and state.accepted == 6
    assert {p: p.stat().st_mtime_ns for p in files} == files
    added = {p for p in (tmp_path / "monitor" / "windows").rglob("*.parquet")} - set(files)
    assert {p.parent.parent.name for p in added} == {"span=2026010101"} and {p.parent.name for p in added} == {"pass=2"}
    journal = frame(spark, *hours, late[0])
    assert same_rows(metrics.metric_windows(metrics.dedup_events(journal)), store.read("windows"))
    with pytest.raises(PySparkException, match="conflicting payload"):
        store.collect(frame(spark, event("h4", 4 * 3600 + 20, *counts, {"attempted": 9})), rejected, NOW)
    assert store.state() == state


def test_passes_in_any_order_give_what_one_pass_gives(spark, tmp_path):
    r, rejected = random.Random(6), spark.createDataFrame([], REJECTED)
    made = [event(i, r.randrange(300_000), r.choice("xy"), "m", "delta", {"n": r.randrange(9)}, topic=r.choice(["a", "b"])) for i in range(60)]
    made += [event(f"d{i}", r.randrange(300_000), "z", "g", "gauge", {"duration_ms": r.randrange(90)}) for i in range(30)]
    whole = MonitoringStore(spark, str(tmp_path / "whole"))
    whole.collect(frame(spark, *made), rejected, NOW)
    r.shuffle(made)
    store = MonitoringStore(spark, str(tmp_path / "parts"))
    for i in range(0, 90, 45):
        store.collect(frame(spark, *made[max(0, i - 20) : i + 45]), rejected, NOW)
    for name in ("journal", "windows", "active"):
        assert same_rows(whole.read(name), store.read(name)), name


def line(i, at=T, **over):
    stamp = (datetime(2026, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=at)).strftime("%Y-%m-%dT%H:%M:%S.000Z")
    return json.dumps({
        "event_id": f"00000000-0000-4000-8000-{i:012d}", "event_time": stamp, "observed_at": stamp, "component": "shop", "metric_name": "m",
        "metric_semantics": "delta", "status": "OK", "run_id": "r", "values": {"n": i}, "dimensions": {}, "schema_version": "v1",
    } | over)


@pytest.fixture
def logs(tmp_path):
    registry = tmp_path / "registry.json"
    registry.write_text('{"schema_version": "monitoring-quarantine-v1", "entries": []}')
    os.makedirs(tmp_path / "logs")
    (tmp_path / "logs" / "a.jsonl").write_text("\n".join([line(1), line(2), "broken", line(3)[:40]]))
    return tmp_path / "logs" / "a.jsonl", str(tmp_path / "logs" / "*.jsonl"), registry


def test_cursors_move_with_the_tables(spark, tmp_path, logs):
    log, pattern, registry = logs
    store = MonitoringStore(spark, str(tmp_path / "monitor"))
    _, state = store.collect_files(pattern, str(registry), NOW, split_bytes=100)
    assert (state.accepted, state.rejected) == (2, 1)
    with open(log, "a") as f:
        f.write(line(3)[40:] + "\n" + line(4) + "\n")

    def crash(step):
        if step == "pointer":
            raise OSError("lost")

    with pytest.raises(OSError):
        store.collect_files(pattern, str(registry), NOW, before=crash)
    assert store.state() == state
    changed, after = store.collect_files(pattern, str(registry), NOW, split_bytes=64)
    assert changed and (after.accepted, after.rejected) == (4, 1) and after.snapshot_id != state.snapshot_id
    # nothing new, and a second file with lines that the first has
    assert store.collect_files(pattern, str(registry), NOW) == (False, after)
    log.with_name("b.jsonl").write_text(line(4) + "\n")
    changed, last = store.collect_files(pattern, str(registry), NOW)
    assert changed and last.accepted == 4 and len(last.cursors) == 2
    assert {r.event_id[-1] for r in store.read("journal").collect()} == set("1234")


def test_a_state_that_does_not_fit_is_refused(spark, tmp_path, logs):
    log, pattern, registry = logs
    store = MonitoringStore(spark, str(tmp_path / "monitor"))
    text = log.read_text()
    log.write_text(text + "\n")
    _, state = store.collect_files(pattern, str(registry), NOW)

    def refused(match):
        with pytest.raises(StaleState, match=match):
            store.collect_files(pattern, str(registry), NOW)
        assert store.state() == state

    log.write_text(text[:50])
    refused("truncated")
    log.write_text("x" + text[1:] + "\n" + line(9) + "\n")
    refused("replaced")
    os.rename(log, log.with_name("gone"))
    refused("gone")
    log.write_text(text + "\n")
    said = registry.read_text()
    registry.write_text(said + " ")
    refused("registry")
    registry.write_text(said)
    assert store.collect_files(pattern, str(registry), NOW) == (False, state)
    shutil.rmtree(tmp_path / "monitor" / "journal")
    refused("journal is behind")


def test_a_torn_version_is_refused(spark, tmp_path):
    store = VersionedTables(spark, str(tmp_path / "versions"))
    with pytest.raises(TornVersion, match="nothing"), store.snapshot():
        pass
    store.publish({"a": spark.range(5), "b": spark.range(3)}, version="one", content=True)
    with store.snapshot(content=True) as found:
        assert found["a"].count() == 5 and set(found) == {"a", "b"}
    with pytest.raises(TornVersion, match="replaced"), store.snapshot():
        store.publish({"a": spark.range(6), "b": spark.range(3)}, version="two")
    with pytest.raises(TornVersion, match="rows"), store.snapshot():
        spark.range(7).write.mode("append").parquet(str(tmp_path / "versions" / "two" / "a"))
    store.publish({"a": spark.range(5), "b": spark.range(3)}, version="three", content=True)
    spark.range(10, 15).write.mode("overwrite").parquet(str(tmp_path / "versions" / "three" / "a"))
    with store.snapshot() as found:  # as many rows: only the content tells
        assert found["b"].count() == 3
    with pytest.raises(TornVersion, match="other ones"), store.snapshot(content=True):
        pass
    shutil.rmtree(tmp_path / "versions" / "three" / "b")
    with pytest.raises(TornVersion, match="cannot be read"), store.snapshot():
        pass


def test_windows_of_another_pass_are_refused(spark, tmp_path):
    store, rejected = MonitoringStore(spark, str(tmp_path / "monitor")), spark.createDataFrame([], REJECTED)
    store.collect(frame(spark, event("a", T, "x", "m", "delta", {"n": 1})), rejected, NOW)
    assert store.load()["windows"].count() == 1
    windows = next((tmp_path / "monitor" / "windows").glob("span=*/pass=1"))
    spark.read.parquet(str(windows)).limit(0).write.mode("overwrite").parquet(str(windows))
    with pytest.raises(TornVersion, match="do not match"):
        store.load()


def test_ranges_give_each_line_once(tmp_path):
    r = random.Random(4)
    text = b"".join(bytes(r.choice(b"ab\r ") for _ in range(r.randrange(30))) + b"\n" for _ in range(80)) + b"x" * 200_000 + b"\n\ntail"
    path = tmp_path / "log"
    path.write_bytes(text)
    want, at = [], 0
    for part in text.split(b"\n")[:-1]:
        want.append((at, part + b"\n"))
        at += len(part) + 1
    for cuts in ([0, len(text)], list(range(0, 900, 7)) + [len(text)], [0, 5, 6, 7, 1000, 150_000, len(text) - 2, len(text)]):
        for name in (str(path), f"file://{path}"):
            got = [x for a, b in zip(cuts, cuts[1:], strict=False) for x in lines_ending_in(name, a, b, block=50)]
            assert got == want
    assert matching(f"file://{tmp_path}/l*") == {f"file://{tmp_path}/log": len(text)} and matching(str(tmp_path / "no" / "*")) == {}

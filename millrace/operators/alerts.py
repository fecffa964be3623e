"""Alert rules over metric history and the alert state machine. Survey ids A22, A23, J8, J10, T-13, T-14, F23, F24.

Events: event_id, event_time and observed_at (timestamps), component, metric_name, metric_semantics, status, run_id,
values (map of doubles), dimensions (map of strings). Signals are few rows; nothing is collected.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.ids import fingerprint, iso_millis, uuid5

# Components, metrics and thresholds (warning, critical) of the five rules.
INGEST, SILVER = "kafka_to_bronze_dlq", "bronze_to_silver_incremental"
FRESHNESS_SECONDS = (75.0, 300.0)
INVALID_RATE = (0.25, 0.40)
INVALID_BATCHES, INVALID_LEAST_ROWS = 10, 100
DURATION_MS = (25_000.0, 75_000.0)
DURATION_BATCHES = 3

TRANSITIONS = uuid.uuid5(uuid.NAMESPACE_URL, "millrace/alert-transition")
_COLUMNS = ["fingerprint", "alert_name", "component", "topic", "severity", "observed_value", "threshold", "evidence_event_id"]


def _of(events: DataFrame, component: str, metric: str) -> DataFrame:
    return events.filter((F.col("component") == component) & (F.col("metric_name") == metric))


def _last(events: DataFrame, n: int = 1) -> DataFrame:
    """The last n events of one metric: a bounded cut, numbered from the newest."""
    cut = events.orderBy(F.desc("event_time"), F.desc("event_id")).limit(n)
    return cut.withColumn("_nth", F.row_number().over(Window.orderBy(F.desc("event_time"), F.desc("event_id"))))


def _newest(column: str) -> Column:
    return F.max_by(column, F.struct("event_time", "event_id"))


def _graded(value: Column, limits: tuple[float, float]) -> tuple[Column, Column]:
    low, high = limits
    severity = F.when(value > high, "CRITICAL").when(value > low, "WARNING")
    return severity, F.when(value > high, F.lit(float(high))).otherwise(F.lit(float(low)))


def _signal(df: DataFrame, name: str, component: str, severity: Column, value: Column, threshold: Column) -> DataFrame:
    topic = F.coalesce("topic", F.lit(""))
    return df.select(
        fingerprint(F.lit(name), F.lit(component), topic).alias("fingerprint"), F.lit(name).alias("alert_name"),
        F.lit(component).alias("component"), "topic", severity.alias("severity"), value.cast("double").alias("observed_value"),
        threshold.cast("double").alias("threshold"), F.col("event_id").alias("evidence_event_id"),
    ).filter("severity is not null")


def evaluate(events: DataFrame, now: datetime) -> DataFrame:
    """The signals active at ``now`` (an aware time), one row per fingerprint."""
    if now.tzinfo is None:
        raise ValueError("now must be timezone-aware")
    clock = F.lit(now.timestamp())
    topic = F.col("dimensions")["topic"].alias("topic")
    values = F.col("values")

    producer = _last(_of(events, "producer", "delivery_counts")).select(
        "event_id", "event_time", topic, values["attempted"].alias("attempted"), values["acknowledged"].alias("acknowledged")
    )
    gap = F.col("attempted") - F.col("acknowledged")
    gaps = _signal(producer, "producer_delivery_gap", "producer", F.when(gap > 0, "CRITICAL"), gap, F.lit(0.0))

    committed = _last(_of(events, INGEST, "last_committed")).select((values["committed_at_epoch_ms"] / 1000).alias("committed"))
    at = F.col("event_time").cast("double")
    stale = producer.join(committed, F.lit(True), "left").filter("acknowledged > 0")
    stale = stale.filter(F.col("committed").isNull() | (F.col("committed") < at))
    age = F.greatest(F.lit(0.0), clock - at)
    freshness = _signal(stale, "bronze_freshness", INGEST, _graded(age, FRESHNESS_SECONDS)[0], age, _graded(age, FRESHNESS_SECONDS)[1])

    quality = _of(events, INGEST, "quality_counts").filter(values["batch_input_rows"] > 0)
    recent = _last(quality, INVALID_BATCHES).withColumn("topic", topic)
    rate = recent.agg(
        _newest("event_id").alias("event_id"), _newest("topic").alias("topic"),
        F.sum(values["batch_input_rows"]).alias("rows"), F.sum(values["invalid_count"]).alias("invalid"),
    ).filter(F.col("rows") >= INVALID_LEAST_ROWS)
    share = F.col("invalid") / F.col("rows")
    rates = _signal(rate, "bronze_invalid_rate", INGEST, _graded(share, INVALID_RATE)[0], share, _graded(share, INVALID_RATE)[1])

    batch = F.col("dimensions")["batch_id"].alias("_batch")
    nonempty = quality.select("run_id", batch).distinct()
    timed = _of(events, INGEST, "batch_duration").select("*", batch)
    timed = timed.join(nonempty, timed["run_id"].eqNullSafe(nonempty["run_id"]) & timed["_batch"].eqNullSafe(nonempty["_batch"]), "left_semi")
    least = _last(timed, DURATION_BATCHES).withColumn("topic", topic).agg(
        _newest("event_id").alias("event_id"), _newest("topic").alias("topic"), F.min(values["duration_ms"]).alias("least"),
        F.count(F.lit(1)).alias("batches"),
    ).filter(F.col("batches") == DURATION_BATCHES)
    slow = F.col("least")
    slows = _signal(least, "bronze_batch_duration", INGEST, _graded(slow, DURATION_MS)[0], slow, _graded(slow, DURATION_MS)[1])

    runs = _last(_of(events, SILVER, "run_counts")).withColumn("topic", topic)
    off = F.abs(values["input_rows"] - values["output_rows"])
    rows = _signal(runs, "bronze_silver_row_mismatch", SILVER, F.when(off > 0, "CRITICAL"), off, F.lit(0.0))
    return gaps.unionByName(freshness).unionByName(rates).unionByName(slows).unionByName(rows)


def transitions(previous: DataFrame, active: DataFrame, now: datetime) -> DataFrame:
    """OPEN and RESOLVED rows between two sets of signals; a change of severity is RESOLVED, then OPEN.

    Columns: those of a signal, state, transition_order, occurred_at and a deterministic transition_id.
    """
    a = previous.select(*[F.col(c).alias(f"_old_{c}") for c in _COLUMNS])
    b = active.select(*[F.col(c).alias(f"_new_{c}") for c in _COLUMNS])
    joined = a.join(b, F.col("_old_fingerprint") == F.col("_new_fingerprint"), "full_outer")
    changed = ~F.col("_old_severity").eqNullSafe(F.col("_new_severity"))

    def row(side: str, state: str, order: int) -> Column:
        fields = [F.col(f"_{side}_{c}").alias(c) for c in _COLUMNS]
        return F.struct(F.lit(state).alias("state"), F.lit(order).alias("transition_order"), *fields)

    steps = F.array_compact(
        F.array(
            F.when(F.col("_old_fingerprint").isNotNull(), row("old", "RESOLVED", 0)),
            F.when(F.col("_new_fingerprint").isNotNull(), row("new", "OPEN", 1)),
        )
    )
    stamped = joined.filter(changed).select(F.explode(steps).alias("t")).select("t.*")
    at = iso_millis(F.timestamp_seconds(F.lit(now.timestamp())))
    name = F.concat_ws("|", "fingerprint", "state", "severity", at)
    return stamped.withColumn("occurred_at", at).withColumn("transition_id", uuid5(TRANSITIONS, name))

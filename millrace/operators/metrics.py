"""Additive metrics by minute, and semantics-aware five-minute windows. Survey ids A1, A2, A5, A18-A22, A24, W3, W4."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.contract import BUSINESS

MINUTE = "yyyyMMddHHmm"

# The minute metrics, in the contract's order.
MINUTE_METRICS = [
    "events_total", "valid_count", "warning_count", "invalid_count", "record_count", "quantity_sum", "gross_item_value",
    "successful_labeled_value", "rating_sum", "rating_count",
]

# Gauges of which a window keeps the greatest value.
MAX_GAUGES = [
    ("kafka_to_bronze_dlq", "last_committed", "committed_at_epoch_ms"),
    ("bronze_to_silver_incremental", "checkpoint_progress", "last_batch_id"),
]


def minute_key(ts: str | Column) -> Column:
    return F.date_format(ts, MINUTE)


def measures_by(df: DataFrame, keys: Mapping[str, Column], measures: Mapping[str, Column]) -> DataFrame:
    """Sums of measure columns by computed keys, one shuffle with map-side partial sums."""
    return df.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(*[F.sum(c).alias(n) for n, c in measures.items()])


def commerce_minutes(validated: DataFrame, paid: str, ts: str = "kafka_timestamp") -> DataFrame:
    """The ten minute metrics: all rows count as events, only VALID and WARNING ones as business."""
    status = F.col("validation_status")
    business = status.isin(*BUSINESS)
    rated = business & F.col("overall").isNotNull()

    def flag(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0).cast("long")

    def amount(condition: Column, column: str, kind: str) -> Column:
        return F.when(condition, F.col(column)).otherwise(0).cast(kind)

    measures = {
        "events_total": F.lit(1).cast("long"),
        "valid_count": flag(status == "VALID"),
        "warning_count": flag(status == "WARNING"),
        "invalid_count": flag(status == "INVALID"),
        "record_count": flag(business),
        "quantity_sum": amount(business, "quantity", "long"),
        "gross_item_value": amount(business, "totalAmount", "double"),
        "successful_labeled_value": amount(business & (F.col("paymentStatus") == paid), "totalAmount", "double"),
        "rating_sum": amount(rated, "overall", "double"),
        "rating_count": flag(rated),
    }
    return measures_by(validated, {"ingest_minute": minute_key(ts)}, {name: measures[name] for name in MINUTE_METRICS})


def rollup(metrics: DataFrame, measures: Sequence[str], key: str = "ingest_minute") -> DataFrame:
    """The metric rows and their total, whose key is null, in one grouping-sets aggregate."""
    totals = [F.sum(m).alias(m) for m in measures]
    return metrics.groupingSets([[F.col(key)], []], F.col(key)).agg(*totals)


def dedup_events(events: DataFrame, id_col: str = "event_id", ignored: Sequence[str] = ("observed_at",)) -> DataFrame:
    """One row per event id. Retries that differ in ignored columns only are one event; any other difference is an error.

    Of retries the first in the order of the ignored columns stays. The check is part of the aggregate: reading a
    conflicting row fails the query.
    """
    same = [c for c in events.columns if c not in (id_col, *ignored)]
    # null fields do not count, and maps compare by their JSON
    text = F.to_json(F.struct(*same), {"ignoreNullFields": "false"})
    whole = F.struct(*ignored, *same)
    grouped = events.withColumn("_print", F.sha2(text, 256)).groupBy(id_col).agg(
        F.min("_print").alias("_low"), F.max("_print").alias("_high"),
        F.min_by(whole, F.struct(*ignored, "_print")).alias("_row"),
    )
    message = F.concat(F.lit("conflicting payload for event_id="), F.col(id_col).cast("string"))
    checked = F.when(F.col("_low") == F.col("_high"), F.col("_row")).otherwise(F.raise_error(message))
    return grouped.withColumn("_row", checked).select(*[F.col(c) if c == id_col else F.col(f"_row.{c}").alias(c) for c in events.columns])


#: Powers of ten from which on sums are kept apart, with 18 digits below each.
_TIERS = range(-27, 27, 9)


def steady_sum(value: Column) -> Column:
    """A sum of doubles that does not depend on the order of partial sums.

    Numbers of like size, from 1e-27 up to 1e27, are summed as decimals, of which each holds 10**11 numbers; the few sums are then
    added from the smallest size up. Zeros add nothing, and what is smaller or larger is summed as doubles.
    """
    size, out, inside = F.abs(value), F.lit(0.0), F.lit(False)
    for tier in _TIERS:
        own = (size >= float(f"1e{tier}")) & (size < float(f"1e{tier + 9}"))
        inside = inside | own
        scaled = F.when(own, value * float(f"1e{-tier}")).cast("decimal(38,18)")
        out = out + F.coalesce(F.sum(scaled).cast("double"), F.lit(0.0)) * float(f"1e{tier}")
    return out + F.coalesce(F.sum(F.when(~inside, value)), F.lit(0.0))


def metric_windows(events: DataFrame, minutes: int = 5) -> DataFrame:
    """Metric rows by window, component, metric and topic.

    Deltas are summed, gauges and cumulatives take the last value by (event_time, observed_at, event_id), listed gauges the
    greatest. A group that mixes semantics or value names is an error. ``duration_ms`` statistics have a p95 from 20
    values on. Columns: window_start, window_end, component, metric_name, topic, metric_semantics, values, statistics,
    status, status_counts, event_count.

    An event is a row for its status and one for each value; one aggregate makes a row for each status and name of a group, a
    second one, over those few rows, the group.
    """
    by = ["window_start", "window_end", "component", "metric_name", "topic"]
    window = F.window("event_time", f"{minutes} minutes")
    own = F.struct(F.lit(None).cast("string").alias("name"), F.col("status").alias("status"), F.lit(None).cast("double").alias("value"))
    of_value = lambda e: F.struct(e["key"].alias("name"), F.lit(None).cast("string").alias("status"), e["value"].alias("value"))
    parts = F.concat(F.array(own), F.coalesce(F.transform(F.map_entries("values"), of_value), F.array().cast("array<struct<name:string,status:string,value:double>>")))
    e = events.select(
        window.start.alias("window_start"), window.end.alias("window_end"), "component", "metric_name",
        F.col("dimensions")["topic"].alias("topic"), "metric_semantics", F.struct("event_time", "observed_at", "event_id").alias("_order"),
        F.array_join(F.array_sort(F.map_keys("values")), ",").alias("_names"), F.explode(parts).alias("_part"),
    ).select("*", "_part.*")
    duration = F.when(F.col("name") == "duration_ms", F.col("value"))
    each = e.groupBy(*by, "name", "status").agg(
        F.min("metric_semantics").alias("_kind"),
        F.max("metric_semantics").alias("_other"),
        F.min("_names").alias("_names"),
        F.max("_names").alias("_other_names"),
        F.count(F.lit(1)).alias("_n"),
        F.max("_order").alias("_latest"),
        steady_sum(F.col("value")).alias("_sum"),
        F.max_by("value", "_order").alias("_last"),
        F.max("value").alias("_top"),
        F.struct(
            F.count(duration).alias("n"), F.avg(duration).alias("avg"), F.max(duration).alias("max"),
            F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY CASE WHEN name = 'duration_ms' THEN value END)").alias("p95"),
        ).alias("_duration"),
    )
    greatest = F.struct("component", "metric_name", "name").isin(
        *[F.struct(*[F.lit(x).alias(n) for n, x in zip(("component", "metric_name", "name"), g, strict=True)]) for g in MAX_GAUGES]
    )
    value = F.when(F.col("_kind") == "delta", F.col("_sum")).when((F.col("_kind") == "gauge") & greatest, F.col("_top")).otherwise(F.col("_last"))
    is_value = F.col("name").isNotNull()

    def as_map(condition: Column, key: str, held: Column) -> Column:
        # a row a name or status of the group, so the lists are as short as an event
        return F.map_from_entries(F.array_sort(F.collect_list(F.when(condition, F.struct(F.col(key).alias("key"), held.alias("value"))))))

    one = each.groupBy(*by).agg(
        F.min("_kind").alias("metric_semantics"), F.max("_other").alias("_other"), F.min("_names").alias("_names"), F.max("_other_names").alias("_other_names"),
        F.sum(F.when(~is_value, F.col("_n"))).alias("event_count"), as_map(is_value, "name", value).alias("values"),
        as_map(~is_value, "status", F.col("_n")).alias("status_counts"), F.max_by("status", F.when(~is_value, F.col("_latest"))).alias("_status"),
        F.max(F.when(F.col("name") == "duration_ms", F.col("_duration"))).alias("_duration"),
    )
    mixed = (F.col("metric_semantics") != F.col("_other")) | (F.col("_names") != F.col("_other_names"))
    unknown = ~F.col("metric_semantics").isin("delta", "gauge", "cumulative")
    name = F.concat_ws(".", "component", "metric_name")
    checked = F.when(mixed, F.raise_error(F.concat(F.lit("inconsistent semantics/values for "), name))).when(
        unknown, F.raise_error(F.concat(F.lit("unsupported metric_semantics="), F.col("metric_semantics")))
    ).otherwise(F.col("metric_semantics"))
    n = F.coalesce(F.col("_duration.n"), F.lit(0))
    statistics = F.when(
        n > 0,
        F.map_filter(
            F.create_map(
                F.lit("duration_ms_avg"), F.col("_duration.avg"), F.lit("duration_ms_max"), F.col("_duration.max"),
                F.lit("duration_ms_p95"), F.when(n >= 20, F.col("_duration.p95")),
            ),
            lambda _, v: v.isNotNull(),
        ),
    ).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>")))
    return one.select(
        *by, checked.alias("metric_semantics"), "values", statistics.alias("statistics"), F.col("_status").alias("status"),
        "status_counts", "event_count",
    )


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by the order columns; columns keep their order and nulls."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def histogram(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))

"""What a streaming ingest has committed, batch by batch, from its sinks and checkpoints alone. Survey ids T-7, S6, S10, S11, A25.

A batch counts once every sink's log has it. Its rows are those between the offsets that its checkpoint has for the batch before
and for itself, so that a batch whose log was compacted, and names the files of all earlier ones, is counted like any other.
Sinks must have been given the same offsets, and together hold as many rows as lie between them.

The events of a batch have deterministic ids. A pass writes those that the event log lacks, so that a pass that failed
half-way, or a restarted driver, is made up for by the next one, and nothing is kept in memory between passes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.ids import uuid5
from millrace.sources.byte_log import read_events, write_events
from millrace.sources.tables import checkpoint_offsets, commit_log
from millrace.streaming.progress import EVENTS, SCHEMA_VERSION

# The statuses that belong into either sink.
ROUTES = {"bronze": ("VALID", "WARNING"), "dlq": ("INVALID",)}


def batch_ranges(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(batch_id, topic, partition, low, high): the offsets [low, high) of each batch that the checkpoint still has.

    A partition's first batch starts at 0; of the first batch that is kept, the offsets are known only if it is batch 0. Fails
    where an offset falls or a partition vanishes.
    """
    offsets = checkpoint_offsets(spark, checkpoint)
    along = Window.partitionBy("topic", "partition").orderBy("batch_id")
    ends = offsets.agg(F.min("batch_id").alias("_first"), F.max("batch_id").alias("_last"))
    rows = offsets.crossJoin(ends).withColumns({"_low": F.lag("offset").over(along), "_next": F.lead("batch_id").over(along)})
    where = F.concat_ws(" ", "topic", F.col("partition").cast("string"), F.lit("in batch"), F.col("batch_id").cast("string"))
    fell = F.raise_error(F.concat(F.lit("offset regressed: "), where)).cast("long")
    gone = F.raise_error(F.concat(F.lit("partition vanished: "), where)).cast("long")
    high = F.when(F.col("_low") > F.col("offset"), fell).when((F.col("batch_id") < F.col("_last")) & F.col("_next").isNull(), gone).otherwise(F.col("offset"))
    known = rows.filter((F.col("batch_id") > F.col("_first")) | (F.col("batch_id") == 0))
    return known.select("batch_id", "topic", "partition", F.coalesce("_low", F.lit(0)).alias("low"), high.alias("high"))


def rows_by_batch(spark: SparkSession, path: str, ranges: DataFrame, status: str = "validation_status") -> DataFrame:
    """(batch_id, status, rows) of the committed rows of a sink that lie in the ranges of batches.

    The least offset of the ranges reaches the scan, so that row groups of older batches are skipped by their statistics.
    """
    least = ranges.agg(F.min("low")).first()[0]
    rows = spark.read.parquet(path).select("kafka_topic", "kafka_partition", "kafka_offset", F.col(status).alias("status"))
    rows = rows.filter(F.col("kafka_offset") >= (least or 0))
    same = (F.col("topic") == F.col("kafka_topic")) & (F.col("partition") == F.col("kafka_partition"))
    inside = rows.join(ranges, same & (F.col("kafka_offset") >= F.col("low")) & (F.col("kafka_offset") < F.col("high")))
    return inside.groupBy("batch_id", "status").agg(F.count(F.lit(1)).alias("rows"))


def _committed(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(batch_id, committed_at, compact) of the batches that all sinks have; committed_at is the time of the last log."""
    logs = [{number: (ms, compact) for number, compact, ms in commit_log(spark, path)} for path in paths]
    common = set.intersection(*map(set, logs)) if logs else set()
    rows = [(b, max(log[b][0] for log in logs), any(log[b][1] for log in logs)) for b in sorted(common)]
    named = spark.createDataFrame(rows, "batch_id long, ms long, compact boolean")
    return named.select("batch_id", F.timestamp_millis("ms").alias("committed_at"), "compact")


def observe(spark: SparkSession, sinks: Mapping[str, str], checkpoints: Mapping[str, str], status: str = "validation_status", after: int = -1) -> DataFrame:
    """A row for each batch over ``after`` that all sinks have committed: batch_id, committed_at, compact, input_rows, VALID, WARNING and
    INVALID counts, and ``problem``, null for a batch that adds up.

    ``sinks`` and ``checkpoints`` have the same names, those of :data:`ROUTES`. Batches whose offsets the checkpoint no longer has
    are left out.
    """
    ranges = {name: batch_ranges(spark, path).filter(F.col("batch_id") > after) for name, path in checkpoints.items()}
    first = next(iter(sinks))
    spans = [
        r.groupBy("batch_id").agg(F.sum(F.col("high") - F.col("low")).alias(f"_rows_{name}"),
                                  F.sort_array(F.collect_list(F.struct("topic", "partition", "low", "high"))).alias(f"_at_{name}"))
        for name, r in ranges.items()
    ]
    known = reduce(lambda a, b: a.join(b, "batch_id"), spans, _committed(spark, list(sinks.values())))
    counts = [
        rows_by_batch(spark, path, ranges[name], status).select("batch_id", "status", "rows", F.col("status").isin(*ROUTES[name]).alias("_routed"))
        for name, path in sinks.items()
    ]
    counted = reduce(DataFrame.unionByName, counts).groupBy("batch_id").agg(
        *[F.coalesce(F.sum(F.when((F.col("status") == s) & F.col("_routed"), F.col("rows"))), F.lit(0)).alias(s) for route in ROUTES.values() for s in route],
        F.coalesce(F.sum(F.when(~F.coalesce("_routed", F.lit(False)), F.col("rows"))), F.lit(0)).alias("_strays"),
    )
    names = [s for route in ROUTES.values() for s in route]
    joined = known.join(counted, "batch_id", "left").fillna(0, [*names, "_strays"])
    unlike = reduce(lambda a, b: a | b, [F.col(f"_at_{n}") != F.col(f"_at_{first}") for n in sinks], F.lit(False))
    total = sum((F.col(s) for s in names), F.lit(0))
    problem = (
        F.when(unlike, "sinks have other offsets")
        .when(F.col("_strays") > 0, "unexpected status")
        .when(total != F.col(f"_rows_{first}"), "rows do not match the offsets")
    )
    return joined.select("batch_id", "committed_at", "compact", F.col(f"_rows_{first}").alias("input_rows"), *names, problem.alias("problem"))


def commit_events(observed: DataFrame, component: str, run_id: str, topic: str, durations: DataFrame | None = None) -> DataFrame:
    """Three events of each batch without a problem, as :func:`millrace.streaming.progress.batch_events` names them.

    ``durations``: (batch_id, duration_ms), of the slower sink; batches that it lacks get no duration event until it has them.
    """
    good = observed.filter("problem is null")
    good = good.join(durations, "batch_id", "left") if durations is not None else good.withColumn("duration_ms", F.lit(None).cast("long"))

    def values(**named: Column) -> Column:
        return F.create_map(*[x for k, v in named.items() for x in (F.lit(k), v.cast("double"))])

    kinds = [
        ("quality_counts", "delta", values(batch_input_rows=F.col("input_rows"), valid_count=F.col("VALID"), warning_count=F.col("WARNING"), invalid_count=F.col("INVALID"))),
        ("batch_duration", "gauge", values(duration_ms=F.col("duration_ms"))),
        ("last_committed", "gauge", values(committed_at_epoch_ms=F.unix_millis("committed_at"))),
    ]
    out = []
    for metric, semantics, value in kinds:
        identity = F.format_string(f'["{component}", "{metric}", "{run_id}", {{"batch_id": %d}}]', "batch_id")
        out.append(
            good.filter("duration_ms is not null" if metric == "batch_duration" else "true").select(
                uuid5(EVENTS, identity).alias("event_id"), F.col("committed_at").alias("event_time"), F.col("committed_at").alias("observed_at"),
                F.lit(component).alias("component"), F.lit(metric).alias("metric_name"), F.lit(semantics).alias("metric_semantics"),
                F.lit("OK").alias("status"), F.lit(run_id).alias("run_id"), value.alias("values"),
                F.create_map(F.lit("topic"), F.lit(topic), F.lit("batch_id"), F.col("batch_id").cast("string")).alias("dimensions"),
                F.lit(SCHEMA_VERSION).alias("schema_version"),
            )
        )
    return reduce(DataFrame.unionByName, out)


def publish_commits(events: DataFrame, path: str) -> int:
    """Writes the events that the folder of JSON lines lacks, in one job; returns how many. What fails is written by the next pass."""
    missing = events.join(read_events(events.sparkSession, path).select("event_id"), "event_id", "left_anti").select(*events.columns).persist()
    try:
        count = missing.count()  # a few events a batch
        if count:
            write_events(missing, path)
        return count
    finally:
        missing.unpersist()

"""Streaming ingest, increments and serving. Survey ids S1, S5, K1, K2, K4, K5, T-1 to T-10, O2.

Each query has its own checkpoint, so that one that fails or lags does not hold the others back; two sinks are never
written in one batch function. A batch that is replayed overwrites what it wrote before, so results do not change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import checks, normalize
from millrace.operators.contract import Contract, route, validate_json
from millrace.operators.current import top_n
from millrace.operators.metrics import MINUTE

CLEAN_COLUMNS = [
    "payload", "raw_payload", "message_key", *normalize.LINEAGE, "kafka_timestamp", "ingested_at", "validation_status",
    "validation_errors", "validation_warnings", "contract_version", "ingest_date",
]
DLQ_COLUMNS = [*CLEAN_COLUMNS, "missing_fields", "unexpected_fields"]


def layers(source: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """The clean and the dead-letter rows of a log, batch or stream."""
    checked = validate_json(source, contract).withColumn("ingest_date", F.to_date("ingested_at"))
    clean, dead = route(checked)
    return clean.select(*CLEAN_COLUMNS), dead.select(*DLQ_COLUMNS)


def parquet_sink(
    df: DataFrame, name: str, path: str, checkpoint: str, partition_by: Sequence[str], trigger: dict, files: int | None = None
) -> StreamingQuery:
    """An append-only Parquet query. ``files``: at most this many files a batch, without a shuffle."""
    df = df.coalesce(files) if files else df
    writer = df.writeStream.queryName(name).format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint).partitionBy(*partition_by)
    return writer.trigger(**trigger).start()


def start_ingest(
    source: DataFrame, contract: Contract, clean_path: str, dlq_path: str, checkpoints: str, trigger: dict | None = None,
    files: int | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Two independent queries over one source plan; default trigger 25 seconds.

    ``files`` also bounds the tasks that validate a batch, so only sources of small batches should set it.
    """
    trigger = trigger or {"processingTime": "25 seconds"}
    clean, dead = layers(source, contract)
    by = ["contract_version", "ingest_date"]
    return (
        parquet_sink(clean, "bronze", clean_path, f"{checkpoints}/bronze", by, trigger, files),
        parquet_sink(dead, "dlq", dlq_path, f"{checkpoints}/dlq", by, trigger, files),
    )


def await_all(spark: SparkSession, queries: Sequence[StreamingQuery]) -> None:
    """Waits until any query ends; then stops the others and raises what ended it."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
    for q in queries:
        if q.exception():
            raise q.exception()


def file_stream(spark: SparkSession, path: str, files_per_trigger: int = 10) -> DataFrame:
    """A Parquet folder as a stream, with the schema of what it holds now."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("basePath", path).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def silver_increment(
    spark: SparkSession, bronze_path: str, silver_path: str, checkpoint: str, partitions: int | None = None, files_per_trigger: int = 10
) -> StreamingQuery:
    """Bronze files that are new since the last run become silver; ends when it has caught up.

    Tasks write what they have read, since one date may be all of a batch; ``partitions``: at most this many files a batch. Lineage is not deduplicated across batches: the state would grow for ever, and reconciliation finds repeats.
    """
    silver = normalize.to_silver(file_stream(spark, bronze_path, files_per_trigger), deduplicate=False)
    by = ["silver_schema_version", "ingest_date"]
    query = parquet_sink(silver, "silver", silver_path, checkpoint, by, {"availableNow": True}, partitions)
    query.awaitTermination()
    return query


def bounded_dedup(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Optional streaming dedup whose state is bounded by a watermark (extension)."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def gated_silver(silver: DataFrame) -> DataFrame:
    """Fails if a batch breaks the staging gate; one pass over the batch."""
    required = [c for c in normalize.silver_columns() if c not in (*normalize.NOT_STAGED, "reviewer_name")]
    found = checks.gate(
        silver, normalize.LINEAGE, required,
        {
            "invalid_status": ~F.col("validation_status").isin("VALID", "WARNING"),
            "amount_mismatch": F.col("total_amount") != F.col("unit_price") * F.col("quantity"),
        },
    ).first()
    wrong = {k: found[k] for k in ("null_required", "invalid_status", "amount_mismatch") if found[k]}
    if found["distinct_keys"] != found["row_count"]:
        wrong["repeated_lineage"] = found["row_count"] - found["distinct_keys"]
    if wrong:
        raise ValueError(f"staging gate: {wrong}")
    return silver


def staging_increment(spark: SparkSession, silver_path: str, table_path: str, checkpoint: str, files_per_trigger: int = 10) -> StreamingQuery:
    """New silver files through the gate into the staging table, a folder per batch; a replay replaces its folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            staged = normalize.staging_batch(gated_silver(batch), f"{batch_id:08d}")
            staged.write.mode("overwrite").parquet(f"{table_path}/batch={batch_id}")
        finally:
            batch.unpersist()

    stream = file_stream(spark, silver_path, files_per_trigger)
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


class ServingStore:
    """The read model: additive minute metrics, their sums, the newest rows and the health of the last batch, a delta a batch.

    A delta is written under its batch id and overwritten by a replay, so that no marker is needed and none can expire. Readers
    sum the deltas. ``compact`` folds closed batches into one table that is named by the last of them; from then on a replay of
    one of them changes nothing. Minutes more than ``retention`` minutes older than the newest one are not shown; a fold adds
    them to the sums and leaves them out, so that what is stored stops growing while the sums still count every event.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: str, measures: Sequence[str], latest_order: Sequence[str], latest_rows: int = 100,
        retention: int | None = None,
    ):
        """``key``: the minute as yyyyMMddHHmm. ``retention``: minutes, 48 hours being 2,880; None keeps all."""
        self.spark, self.path, self.key, self.measures = spark, path.rstrip("/"), key, list(measures)
        self.order, self.rows, self.retention = [F.desc(c) for c in latest_order], latest_rows, retention

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _glob(self, pattern: str) -> list:
        return self._files()[0].globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}")) or []

    def folds(self) -> list[int]:
        """The last batches of complete folds, in order."""
        return sorted(int(s.getPath().getParent().getParent().getName()) for s in self._glob("folds/*/health/_SUCCESS"))

    def folded(self) -> int:
        """The last batch of the newest complete fold, -1 before the first."""
        return max(self.folds(), default=-1)

    def _deltas(self, name: str, after: int) -> DataFrame | None:
        if not self._glob(f"{name}/batch=*"):
            return None
        deltas = self.spark.read.parquet(f"{self.path}/{name}")
        return deltas.filter(F.col("batch") > after)

    def _read(self, name: str, upto: int | None = None) -> DataFrame:
        """The newest fold and the deltas after it, up to a batch."""
        fold = self.folded()
        parts = [self.spark.read.parquet(f"{self.path}/folds/{fold}/{name}")] if fold >= 0 else []
        deltas = self._deltas(name, fold)
        if deltas is not None:
            parts.append((deltas if upto is None else deltas.filter(F.col("batch") <= upto)).drop("batch"))
        if not parts:
            raise ValueError(f"no batch has been applied in {self.path}")
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def compact(self, upto: int) -> None:
        """Folds all batches up to this one; they must be closed. A crash before the end leaves the fold before in force.

        What the fold before has replaced is deleted, and that fold stays until the next one, for readers that are at it.
        """
        before = self.folded()
        if upto <= before:
            return
        minutes, fold = self._summed(self._read("minutes", upto)), f"{self.path}/folds/{upto}"
        shown = self._shown(minutes)
        shown.write.mode("overwrite").parquet(f"{fold}/minutes")
        gone = minutes.join(shown.select(self.key), self.key, "left_anti").select(*self.measures)
        if before >= 0:
            gone = gone.unionByName(self.spark.read.parquet(f"{self.path}/folds/{before}/expired"))
        gone.agg(*[F.sum(m).alias(m) for m in self.measures]).write.mode("overwrite").parquet(f"{fold}/expired")
        top_n(self._read("latest", upto), self.order, self.rows).write.mode("overwrite").parquet(f"{fold}/latest")
        self._last_health(self._read("health", upto)).write.mode("overwrite").parquet(f"{fold}/health")
        fs, _ = self._files()
        for name in ("minutes", "latest", "health"):
            for status in self._glob(f"{name}/batch=*"):
                if int(status.getPath().getName().removeprefix("batch=")) <= before:
                    fs.delete(status.getPath(), True)
        for status in self._glob("folds/*"):
            if int(status.getPath().getName()) < before:
                fs.delete(status.getPath(), True)

    def _summed(self, deltas: DataFrame) -> DataFrame:
        return deltas.groupBy(self.key).agg(*[F.sum(m).alias(m) for m in self.measures])

    def _shown(self, minutes: DataFrame) -> DataFrame:
        """The minutes that have not expired, by the newest one."""
        if self.retention is None:
            return minutes
        newest = minutes.agg(F.to_timestamp(F.max(self.key), MINUTE).alias("_newest"))
        age = F.unix_timestamp("_newest") - F.unix_timestamp(F.to_timestamp(self.key, MINUTE))
        return minutes.crossJoin(newest).filter(age <= self.retention * 60).drop("_newest")

    @staticmethod
    def _last_health(rows: DataFrame) -> DataFrame:
        return rows.orderBy(F.desc("last_batch_id")).limit(1)

    def apply(self, minutes: DataFrame, newest: DataFrame, batch_id: int, rows: str | None = None) -> None:
        """``rows``: the measure that counts a batch's rows. A batch without minutes, and one that is folded, changes nothing."""
        if batch_id <= self.folded():
            return
        minutes.select(self.key, *self.measures).write.mode("overwrite").parquet(f"{self.path}/minutes/batch={batch_id}")
        top_n(newest, self.order, self.rows).write.mode("overwrite").parquet(f"{self.path}/latest/batch={batch_id}")
        written = self.spark.read.schema(minutes.select(self.key, *self.measures).schema).parquet(f"{self.path}/minutes/batch={batch_id}")
        health = written.agg(F.count(F.lit(1)).alias("last_minute_buckets"), F.coalesce(F.sum(rows or self.measures[0]), F.lit(0)).cast("long").alias("last_input_rows"))
        health.select(
            F.lit(batch_id).cast("long").alias("last_batch_id"), "last_input_rows", "last_minute_buckets",
            F.current_timestamp().alias("last_updated_at"), F.lit("OK").alias("status"),
        ).filter("last_minute_buckets > 0").write.mode("overwrite").parquet(f"{self.path}/health/batch={batch_id}")

    def minutes(self) -> DataFrame:
        """The sums of minutes that have not expired."""
        return self._shown(self._summed(self._read("minutes")))

    def summary(self) -> DataFrame:
        """The sums of all minutes ever applied."""
        fold, rows = self.folded(), self._read("minutes").select(*self.measures)
        if fold >= 0:
            rows = rows.unionByName(self.spark.read.parquet(f"{self.path}/folds/{fold}/expired"))
        return rows.agg(*[F.sum(m).alias(m) for m in self.measures])

    def latest(self) -> DataFrame:
        return top_n(self._read("latest"), self.order, self.rows)

    def health(self) -> DataFrame:
        """One row of the last batch that had rows: last_batch_id, last_input_rows, last_minute_buckets, last_updated_at, status."""
        return self._last_health(self._read("health"))

    def has_marker(self, batch_id: int) -> bool:
        """Whether a batch is applied for good: folded, or with its own delta."""
        return batch_id <= self.folded() or bool(self._glob(f"health/batch={batch_id}/_SUCCESS"))


# The columns that a list of newest events shows, in this order.
LATEST_COLUMNS = [
    "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "orderID", "productName", "category", "region", "quantity",
    "totalAmount", "paymentStatus", "shippingStatus", "overall", "validation_status",
]


def sanitised(validated: DataFrame) -> DataFrame:
    """Clean rows as the list of newest events may show them."""
    return route(validated)[0].select(*LATEST_COLUMNS)


def start_serving(stream: DataFrame, store: ServingStore, minutes, newest, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """``minutes`` and ``newest`` make a batch's metrics and list rows. The batch is kept while both are written."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            store.apply(minutes(batch), newest(batch), batch_id)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "25 seconds"})).start()

"""Batch scans: Parquet snapshots, explicit file lists, commit logs, offsets, fixtures. Survey ids S2-S4, S6-S11, S13, S16, S17."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The log's own names and the names here.
LOG_COLUMNS = {
    "topic": "kafka_topic", "partition": "kafka_partition", "offset": "kafka_offset", "timestamp": "kafka_timestamp",
}


def log_rows(records: DataFrame) -> DataFrame:
    """Log metadata under its own names, key and value as text (S3)."""
    named = [F.col(old).alias(new) for old, new in LOG_COLUMNS.items()]
    return records.select(*named, F.col("key").cast("string").alias("message_key"), F.col("value").cast("string").alias("raw_payload"))


def kafka(spark: SparkSession, servers: str, topic: str, streaming: bool, max_offsets: int = 10_000) -> DataFrame:
    """The topic from its earliest offset, as a rate-limited stream or as a bounded snapshot. Needs the Kafka connector."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("startingOffsets", "earliest").option("failOnDataLoss", "true")
    reader = reader.option("maxOffsetsPerTrigger", max_offsets) if streaming else reader.option("endingOffsets", "latest")
    return log_rows(reader.load())


def parquet_files(spark: SparkSession, base: str, files: Sequence[str]) -> DataFrame:
    """An explicit list of files of a partitioned table, partition columns included."""
    return spark.read.option("basePath", base).parquet(*files)


def data_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """Path, size and modification time of the files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select("path", "length", "modificationTime")


def new_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files of a later listing that an earlier one lacks; reading it fails if a file has vanished."""
    joined = before.select(F.col("path").alias("_old")).join(after, F.col("_old") == F.col("path"), "full_outer")
    vanished = F.raise_error(F.concat(F.lit("committed file vanished: "), F.col("_old")))
    kept = F.when(F.col("path").isNotNull(), F.col("path")).otherwise(vanished)
    return joined.withColumn("path", kept).filter("_old is null").drop("_old")


def commit_log(spark: SparkSession, path: str) -> list[tuple[int, bool, int]]:
    """(batch_id, compact, committed_ms) of a file sink's log, in order: the names and times of its few files, not their contents."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_spark_metadata")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    out = []
    for status in fs.listStatus(folder):
        number, _, kind = status.getPath().getName().partition(".")
        if number.isdecimal() and kind in ("", "compact"):
            out.append((int(number), kind == "compact", int(status.getModificationTime())))
    return sorted(out)


def committed_files(spark: SparkSession, path: str) -> DataFrame:
    """Added files by batch from a file sink's commit log. Version lines and deletions are skipped; ``compact`` marks files
    that a compacted log names, which may be of any earlier batch."""
    # Spark's readers skip this folder on purpose; its few small files come as whole texts
    logs = spark.sparkContext.wholeTextFiles(f"{path.rstrip('/')}/_spark_metadata/*")
    lines = spark.createDataFrame(logs, "file string, content string").select(
        F.explode(F.split("content", "\n")).alias("value"), F.element_at(F.split("file", "/"), -1).alias("_file")
    )
    entry = F.from_json("value", "path string, size long, action string, modificationTime long")
    named = lines.filter(F.col("_file").rlike(r"^\d+(\.compact)?$") & F.col("value").startswith("{"))
    parsed = named.select(entry.alias("e"), "_file").filter("e.action = 'add'")
    return parsed.select(
        F.regexp_extract("_file", r"^(\d+)", 1).cast("long").alias("batch_id"), F.col("_file").endswith(".compact").alias("compact"),
        "e.path", "e.size", F.timestamp_millis("e.modificationTime").alias("modified"),
    )


def committed_batch_files(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """The files that one batch has added. A compacted log names those of all batches: what the logs before it name is taken off.

    Fails if the batch is not committed, or if it is compacted and the logs back to the last compacted one are not all there any
    more; :mod:`millrace.streaming.commits` then counts by the offsets of the checkpoint.
    """
    logs = {number: compact for number, compact, _ in commit_log(spark, path)}
    if batch_id not in logs:
        raise ValueError(f"batch {batch_id} of {path} is not committed")
    files = committed_files(spark, path)
    own = files.filter(F.col("batch_id") == batch_id)
    if not logs[batch_id]:
        return own
    before = batch_id - 1
    while before >= 0 and before in logs and not logs[before]:
        before -= 1
    if before >= 0 and before not in logs:
        raise ValueError(f"the log of batch {before}, which compacted batch {batch_id} follows, is gone")
    earlier = files.filter((F.col("batch_id") < batch_id) & (F.col("batch_id") >= before))
    return own.join(earlier.select("path"), "path", "left_anti")


def committed_status_counts(spark: SparkSession, path: str, batch_id: int | None = None, status: str = "validation_status") -> DataFrame:
    """Rows by status in the files that a sink has committed, of one batch or of all: what is written, not what was reported.

    Only the paths come to the driver, of a batch; all batches are what Spark reads of the table. A file that is listed but gone
    fails the read, and so does a batch that is not committed.
    """
    if batch_id is None:
        return spark.read.parquet(path).groupBy(status).agg(F.count(F.lit(1)).alias("rows"))
    paths = [r.path for r in committed_batch_files(spark, path, batch_id).select("path").distinct().toLocalIterator()]
    if not paths:
        return spark.createDataFrame([], f"{status} string, rows long")
    return parquet_files(spark, path, paths).groupBy(status).agg(F.count(F.lit(1)).alias("rows"))


def checkpoint_offsets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(batch_id, topic, partition, offset) from the offset log of a streaming checkpoint over a partitioned log."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/offsets").select("value", F.col("_metadata.file_name").alias("_file"))
    batch = F.col("_file").cast("long").alias("batch_id")
    topics = F.from_json("value", "map<string,map<string,long>>")
    # the version and metadata lines are no maps of maps of numbers
    rows = lines.filter(F.col("_file").rlike(r"^\d+$") & F.col("value").startswith('{"')).select(batch, F.explode(topics).alias("topic", "_parts"))
    rows = rows.filter("_parts is not null").select("batch_id", "topic", F.explode("_parts").alias("partition", "offset"))
    return rows.withColumn("partition", F.col("partition").cast("int"))


def offset_ranges(before: DataFrame, after: DataFrame) -> DataFrame:
    """Half-open ranges [low, high) by topic and partition. Fails on a partition that goes or an offset that falls."""
    a = before.select(F.col("topic").alias("_t"), F.col("partition").alias("_p"), F.col("offset").alias("_o"))
    same = (F.col("_t") == F.col("topic")) & (F.col("_p") == F.col("partition"))
    joined = a.join(after, same, "full_outer")
    gone = F.raise_error(F.concat_ws(" ", F.lit("partition vanished:"), "_t", F.col("_p").cast("string")))
    fell = F.raise_error(F.concat_ws(" ", F.lit("offset regressed:"), "topic", F.col("partition").cast("string")))
    high = F.when(F.col("offset").isNull(), gone.cast("long")).when(F.col("_o") > F.col("offset"), fell.cast("long"))
    return joined.select("topic", "partition", F.coalesce("_o", F.lit(0)).alias("low"), high.otherwise(F.col("offset")).alias("high"))


def in_ranges(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Log rows inside the ranges: a join on topic and partition, a few rows on the other side."""
    r = ranges.select(F.col("topic").alias("kafka_topic"), F.col("partition").alias("kafka_partition"), "low", "high")
    inside = rows.join(r, ["kafka_topic", "kafka_partition"])
    return inside.filter((F.col("kafka_offset") >= F.col("low")) & (F.col("kafka_offset") < F.col("high"))).drop("low", "high")


def offset_total(offsets: str | Column) -> Column:
    """The sum of all offsets in {topic: {partition: offset}} text; null for null text."""
    topics = F.map_values(F.from_json(offsets, "map<string,map<string,long>>"))
    inner = lambda parts: F.aggregate(F.map_values(parts), F.lit(0).cast("long"), lambda s, v: s + v)
    return F.aggregate(topics, F.lit(0).cast("long"), lambda s, parts: s + inner(parts))


def quarantine_registry(spark: SparkSession, path: str) -> DataFrame:
    """(source, event_id, reason) from the registry's JSON; repeated ids of a source fail."""
    raw = spark.read.option("multiLine", "true").schema(
        "schema_version string, entries array<struct<source:string,reason:string,event_ids:map<string,string>>>"
    ).json(path)
    known = F.when(F.col("schema_version") == "monitoring-quarantine-v1", F.col("entries")).otherwise(
        F.raise_error(F.lit("unsupported quarantine registry version"))
    )
    entry = raw.select(F.explode(known).alias("e")).filter("e.reason <> '' and not contains(e.source, '/')")
    ids = entry.select("e.source", "e.reason", F.explode("e.event_ids").alias("_name", "event_id"))
    by = ids.groupBy("source", "event_id").agg(F.count(F.lit(1)).alias("_n"), F.first("reason").alias("reason"))
    twice = F.raise_error(F.concat(F.lit("duplicate quarantine event_id: "), F.col("event_id")))
    return by.withColumn("reason", F.when(F.col("_n") == 1, F.col("reason")).otherwise(twice)).drop("_n")


def statements(spark: SparkSession, script: str) -> list[DataFrame]:
    """Runs the statements of a SQL script in order; semicolons inside quotes do not separate."""
    parts, quote, now = [], None, ""
    for ch in script:
        quote = None if ch == quote else ch if quote is None and ch in "'\"`" else quote
        if ch == ";" and quote is None:
            parts, now = [*parts, now], ""
        else:
            now += ch
    return [spark.sql(p) for p in (*parts, now) if p.strip()]


def fixture(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    return spark.createDataFrame(list(rows), ddl)


def object_store(endpoint: str, access_key: str, secret_key: str, secure: bool = False) -> Mapping[str, str]:
    """Settings for an S3-compatible store, to pass to a session builder."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(secure).lower(),
    }

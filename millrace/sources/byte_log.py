"""JSON lines read by byte position: complete records only, resumed from a checkpoint. Survey ids S14, S15, T-12, K7.

The source's offset is the size of each file when it was seen. A record ends at a line feed and belongs to the range of bytes that
has it; a tail without one waits for the batch that brings it. The driver lists sizes and hashes heads; tasks find the lines. A
file that shrinks or whose first bytes change is another file under an old name, and the query fails.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from millrace.sources.files import head, lines_ending_in, matching

SCHEMA = "source string, byte_offset long, line string, line_sha256 string"
_NAMES = ["source", "byte_offset", "line", "line_sha256"]
PREFIX_BYTES = 4096
#: Bytes of one input partition; a longer record makes a longer one.
SPLIT_BYTES = 8 << 20
#: Partitions from which on smaller ones grow, up to SPLIT_BYTES: a task a few lines would cost more than its lines.
MANY_RANGES = 256
#: Lines of one Arrow batch, and bytes from which on it is given out before it has them.
_BATCH_LINES, _BATCH_BYTES = 8192, 4 << 20


class _Range(InputPartition):
    def __init__(self, path: str, low: int, high: int):
        self.path, self.low, self.high = path, low, high


def cursor(path: str, size: int) -> str:
    """How far a file has been read, and what its head is: size, length of the head, SHA-256 of the head."""
    length = min(size, PREFIX_BYTES)
    return f"{size}:{length}:{hashlib.sha256(head(path, length)).hexdigest()}"


def cursors(pattern: str) -> dict[str, str]:
    return {path: cursor(path, size) for path, size in matching(pattern).items() if size}


def ranges(start: Mapping[str, str], end: Mapping[str, str], split: int | None = None) -> list[_Range]:
    """The ranges of bytes between two sets of cursors. Fails if a file has gone, shrunk or got another head.

    Ranges have ``split`` bytes; of less than SPLIT_BYTES, only while there are no more than MANY_RANGES of them.
    """
    for path, was in start.items():
        size, length, digest = was.split(":")
        if path not in end or int(end[path].split(":")[0]) < int(size):
            raise ValueError(f"log truncated or gone: {path}")
        if hashlib.sha256(head(path, int(length))).hexdigest() != digest:
            raise ValueError(f"log replaced: {path}")
    spans = [(path, int(start.get(path, "0").split(":")[0]), int(now.split(":")[0])) for path, now in end.items()]
    split = split or SPLIT_BYTES
    split = max(split, min(SPLIT_BYTES, sum(high - low for _, low, high in spans) // MANY_RANGES))
    return [_Range(path, at, min(at + split, high)) for path, low, high in spans for at in range(low, high, split)]


def _read(part: _Range) -> Iterator[pa.RecordBatch]:
    name, kinds = part.path.rsplit("/", 1)[-1], [pa.string(), pa.int64(), pa.string(), pa.string()]
    rows: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=_NAMES)

    for at, line in lines_ending_in(part.path, part.low, part.high):
        rows.append((name, at, line.rstrip(b"\r\n").decode("utf-8", "replace"), hashlib.sha256(line).hexdigest()))
        size += len(line)
        if len(rows) == _BATCH_LINES or size >= _BATCH_BYTES:
            yield batch()
            rows, size = [], 0
    if rows:
        yield batch()


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.pattern, self.split = options["path"], int(options.get("splitBytes", SPLIT_BYTES))

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return cursors(self.pattern)

    def partitions(self, start: dict, end: dict) -> list[_Range]:
        return ranges(start, end, self.split)

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        return _read(part)


class _BatchReader(DataSourceReader):
    def __init__(self, options):
        self.parts = ranges(json.loads(options.get("from", "{}")), json.loads(options["to"]), int(options.get("splitBytes", SPLIT_BYTES)))

    def partitions(self) -> list[_Range]:
        return self.parts

    def read(self, part: _Range | None) -> Iterator[pa.RecordBatch]:
        return _read(part) if part else iter(())


class ByteLog(DataSource):
    """``format("byte_log").option("path", glob)``: files that driver and executors alike can open, by path or address."""

    @classmethod
    def name(cls) -> str:
        return "byte_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> _StreamReader:
        return _StreamReader(self.options)

    def reader(self, schema) -> _BatchReader:
        return _BatchReader(self.options)


def byte_log(spark: SparkSession, pattern: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The stream of complete lines of the files that match."""
    spark.dataSource.register(ByteLog)
    return spark.readStream.format("byte_log").option("path", pattern).option("splitBytes", split_bytes).load()


def lines_between(spark: SparkSession, start: Mapping[str, str], end: Mapping[str, str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The complete lines between two sets of cursors, as a batch."""
    if not any(int(now.split(":")[0]) > int(start.get(path, "0").split(":")[0]) for path, now in end.items()):
        ranges(start, end)  # what is gone or replaced is found without new lines as well
        return spark.createDataFrame([], SCHEMA)
    spark.dataSource.register(ByteLog)
    reader = spark.read.format("byte_log").option("from", json.dumps(dict(start))).option("to", json.dumps(dict(end)))
    return reader.option("splitBytes", split_bytes).load()


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines of files in any store that Spark reads, without positions."""
    return spark.read.text(path).select(
        F.col("_metadata.file_name").alias("source"), F.col("value").alias("line"), F.sha2("value", 256).alias("line_sha256")
    )


ENVELOPE = [
    "event_id", "event_time", "observed_at", "component", "metric_name", "metric_semantics", "status", "run_id", "values",
    "dimensions", "schema_version",
]
_UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def judged_lines(lines: DataFrame) -> DataFrame:
    """Lines with their event as ``e``, its two times, and ``reason``, null for a good one.

    An event has exactly the eleven envelope fields, a UUID, zoned times, known semantics and status, texts that are not
    blank, and at least one finite value.
    """
    from millrace.functions.ids import instant

    shape = (
        "event_id string, event_time string, observed_at string, component string, metric_name string, metric_semantics string, "
        "status string, run_id string, `values` map<string,double>, dimensions map<string,string>, schema_version string"
    )
    e = lines.withColumns({"e": F.from_json("line", shape), "_keys": F.json_object_keys("line"), "_json": F.try_parse_json("line")})
    typed = e.withColumns({"_time": instant(F.col("e.event_time")), "_seen": instant(F.col("e.observed_at"))})
    values = F.map_values("e.values")
    broken = F.lit(False)
    for name in ("component", "metric_name", "schema_version"):
        broken = broken | (F.length(F.trim(F.coalesce(F.col(f"e.{name}"), F.lit("")))) == 0)
    limits = F.exists(values, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    reason = (
        F.when(F.col("_json").isNull() | F.col("_keys").isNull(), "not a JSON object")
        .when(F.array_sort("_keys") != F.array(*map(F.lit, sorted(ENVELOPE))), "unexpected fields")
        .when(~F.coalesce(F.col("e.event_id").rlike(_UUID), F.lit(False)), "event_id is no UUID")
        .when(F.col("_time").isNull() | F.col("_seen").isNull(), "times need an offset")
        .when(~F.coalesce(F.col("e.metric_semantics").isin("delta", "gauge", "cumulative"), F.lit(False)), "unknown semantics")
        .when(~F.coalesce(F.col("e.status").isin("OK", "WARNING", "FAILED"), F.lit(False)), "unknown status")
        .when(broken, "blank text")
        .when(F.coalesce(F.size(values), F.lit(0)) <= 0, "no values")
        .when(limits, "values must be finite numbers")
    )
    return typed.withColumn("reason", reason)


def accepted_events(judged: DataFrame) -> DataFrame:
    return judged.filter("reason is null").select(
        "e.event_id", F.col("_time").alias("event_time"), F.col("_seen").alias("observed_at"), "e.component", "e.metric_name",
        "e.metric_semantics", "e.status", "e.run_id", "e.values", "e.dimensions", "e.schema_version",
    )


def metric_events(lines: DataFrame, quarantine: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Accepted metric events and rejected lines (source, event_id, reason, line_sha256, and byte_offset where known).

    Lines are judged by :func:`judged_lines`; quarantined ids are rejected with their registered reason.
    """
    judged = judged_lines(lines)
    if quarantine is not None:
        q = quarantine.select(F.col("source").alias("_source"), F.col("event_id").alias("_id"), F.col("reason").alias("_why"))
        judged = judged.join(q, (F.col("source") == F.col("_source")) & (F.col("e.event_id") == F.col("_id")), "left")
        judged = judged.withColumn("reason", F.coalesce("_why", "reason"))
    extra = ["byte_offset"] if "byte_offset" in lines.columns else []
    rejected = judged.filter("reason is not null").select("source", *extra, "e.event_id", "reason", "line_sha256")
    return accepted_events(judged), rejected


def write_events(events: DataFrame, path: str) -> None:
    """Appends metric events to a folder of JSON lines, all of them or none.

    ``events`` has the envelope's fields, its times as timestamps. Every line is judged as a reader would judge it before it is
    written, and the first bad one fails the write; tasks that fail or are abandoned leave no line, since Spark moves the parts
    of a job into the folder only once all are done.
    """
    from millrace.functions.ids import iso_millis

    times = {c: iso_millis(F.col(c)) for c in ("event_time", "observed_at")}
    line = F.to_json(F.struct(*ENVELOPE), {"ignoreNullFields": "false"})
    judged = judged_lines(events.withColumns(times).select(line.alias("line")))
    refused = F.raise_error(F.concat(F.lit("metric event refused: "), F.col("reason"), F.lit(": "), F.col("line")))
    judged.select(F.when(F.col("reason").isNull(), F.col("line")).otherwise(refused).alias("value")).write.mode("append").text(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The events of a folder of JSON lines; none if it is not there yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return accepted_events(judged_lines(spark.createDataFrame([], "line string")))
    return accepted_events(judged_lines(json_lines(spark, path)))

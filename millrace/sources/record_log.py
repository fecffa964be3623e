"""A stored log as a stream with the offsets of its topic: records in Parquet, by topic and partition. Survey ids S1, S2, S11.

An archived topic can be replayed through the same jobs as the live one: the source's offsets are ``{topic: {partition: next
offset}}``, as a broker's are, so that checkpoints, ranges and commit observation work alike. Tasks read ranges of offsets; the
driver reads footers only.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from millrace.sources.files import file_system
from millrace.sources.tables import log_rows

SCHEMA = "topic string, partition int, offset long, timestamp timestamp, key binary, value binary"
_COLUMNS = ["topic", "partition", "offset", "timestamp", "key", "value"]


def append_records(records: DataFrame, path: str) -> None:
    """Adds records (the columns of a topic) to a stored log, a file a topic and partition and task."""
    records.select(*_COLUMNS).repartition("topic", "partition").sortWithinPartitions("topic", "partition", "offset").write.mode("append").partitionBy(
        "topic", "partition"
    ).parquet(path)


class _Range(InputPartition):
    def __init__(self, topic: str, partition: int, low: int, high: int):
        self.topic, self.partition, self.low, self.high = topic, partition, low, high


class _Reader(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path = path
        self._tops: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {}

    def _files(self) -> Iterator[tuple[str, int, str]]:
        fs, root = file_system(self.path)
        for info in fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
            names = dict(part.split("=", 1) for part in info.path.split("/") if "=" in part)
            if info.type == pafs.FileType.File and info.path.endswith(".parquet") and {"topic", "partition"} <= set(names):
                yield names["topic"], int(names["partition"]), info.path

    def latestOffset(self) -> dict:
        fs, _ = file_system(self.path)
        out: dict[str, dict[str, int]] = {}
        for topic, partition, path in self._files():
            if path not in self._tops:  # a file never changes
                meta = pq.read_metadata(path, filesystem=fs)
                at = meta.schema.to_arrow_schema().get_field_index("offset")
                groups = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
                self._tops[path] = max((s.max + 1 for s in groups if s is not None and s.has_min_max), default=0)
            parts = out.setdefault(topic, {})
            parts[str(partition)] = max(parts.get(str(partition), 0), self._tops[path])
        return out

    def partitions(self, start: dict, end: dict) -> list[_Range]:
        out = []
        for topic, parts in end.items():
            for partition, high in parts.items():
                low = start.get(topic, {}).get(partition, 0)
                if high > low:
                    out.append(_Range(topic, int(partition), low, high))
        return out

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(self.path)
        files = [path for topic, partition, path in self._files() if (topic, partition) == (part.topic, part.partition)]
        at = ds.field("offset")
        rows = ds.dataset(files, filesystem=fs, format="parquet").scanner(columns=_COLUMNS[2:], filter=(at >= part.low) & (at < part.high))
        for batch in rows.to_batches():
            if batch.num_rows:
                where = [pa.array([part.topic] * batch.num_rows), pa.array([part.partition] * batch.num_rows, pa.int32())]
                times = batch.column("timestamp").cast(pa.timestamp("us", "UTC"))
                yield pa.RecordBatch.from_arrays([*where, batch.column("offset"), times, batch.column("key"), batch.column("value")], names=_COLUMNS)


class RecordLog(DataSource):
    """``format("record_log").option("path", folder)``; driver and executors must see the folder."""

    @classmethod
    def name(cls) -> str:
        return "record_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> _Reader:
        return _Reader(self.options["path"])


def record_log(spark: SparkSession, path: str) -> DataFrame:
    """The stored log as a stream, under the names that jobs use for a log's columns."""
    spark.dataSource.register(RecordLog)
    return log_rows(spark.readStream.format("record_log").option("path", path).load())



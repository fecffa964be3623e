"""Intermediate tables written to the shared folder of the cluster.

Lineage is cut by writing Parquet into ``spark.checkpoint.dir`` and reading it again: columnar, compressed, and readable
after any executor is lost. Tables that a later step has consumed are released; the rest go when the driver ends.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes, as Spark holds rows in memory, up to which a side may be sent to every executor.
BROADCAST_BYTES = 24 << 20

#: Folders of applications on one machine that have no setting, by application id.
_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where the setting is missing on one machine, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # the setting cannot be changed while an application runs
        folder = _own_folders.setdefault(spark.sparkContext.applicationId, "")
        if not folder:
            folder = _own_folders[spark.sparkContext.applicationId] = "file://" + tempfile.mkdtemp(prefix="millrace-")
    return folder.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


class Scratch:
    """Names, writes and releases the intermediate tables of one run of an operator."""

    def __init__(self, spark: SparkSession, operator: str):
        self.spark, self.folder = spark, f"{shared_folder(spark)}/millrace-{operator}-{uuid.uuid4().hex}"
        self.count = 0
        atexit.register(self.close)

    def write(self, df: DataFrame, label: str) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count:03d}-{label}"
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._millrace_path = path
        return back

    def append(self, df: DataFrame, label: str) -> None:
        """Adds the rows to the table of that label, for loops that would else union ever more tables."""
        df.write.mode("append").parquet(f"{self.folder}/{label}")

    def read(self, label: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{label}")

    def release(self, *tables: DataFrame) -> None:
        for table in tables:
            _delete(self.spark, table._millrace_path)

    def close(self) -> None:
        with contextlib.suppress(Exception):
            _delete(self.spark, self.folder)


def _held(kind: T.DataType, value: Column) -> tuple[int, list[Column]]:
    """Bytes that a value takes in a row at any rate, and what it takes besides."""
    if isinstance(kind, T.StringType | T.BinaryType):
        return 16, [F.octet_length(value)]
    if isinstance(kind, T.ArrayType):
        return 24, [F.size(value) * F.lit(_held(kind.elementType, value)[0])]
    if isinstance(kind, T.StructType):
        parts = [_held(f.dataType, value[f.name]) for f in kind.fields]
        return 16 + sum(p[0] for p in parts), [x for p in parts for x in p[1]]
    return (16 if isinstance(kind, T.DecimalType) else 8), []


def bytes_of(table: DataFrame) -> int:
    """Bytes of all rows as Spark holds them in memory; texts inside arrays are not counted."""
    fixed, more = _held(table.schema, F.struct(*table.columns))
    if not more:
        return table.count() * fixed  # from the Parquet footers
    added = F.lit(0).cast("long")
    for x in more:
        added = added + F.coalesce(x.cast("long"), F.lit(0))
    return table.agg(F.coalesce(F.sum(added + fixed), F.lit(0))).first()[0]


def if_small(table: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The table with a broadcast hint if it takes at most ``limit`` bytes; beyond that the join shuffles.

    Meant for tables that :class:`Scratch` has written, as the bytes are counted first.
    """
    return F.broadcast(table) if bytes_of(table) <= limit else table

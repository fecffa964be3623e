"""Versioned tables behind a pointer that is written last. Survey ids K3, K8, K9, S19, T-11, T-15, T-16.

A version is a folder of its own. Readers follow the pointer once and read one version throughout; a crash before the
pointer leaves the old version in place. Each version has a manifest of its tables, with their numbers of rows and ids of what they
hold, taken from what was written; a reader that must not see a torn version checks it before and after it reads.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


MANIFEST = "manifest"


class TornVersion(RuntimeError):
    """A version does not hold what its manifest says, or another one was published meanwhile."""


class VersionedTables:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _pointer(self):
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        path = hadoop.Path(f"{self.path}/CURRENT")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def current(self) -> str | None:
        """The published version, or None."""
        fs, path = self._pointer()
        return self.spark.read.text(str(path.toString())).first()[0] if fs.exists(path) else None

    def read(self, name: str, version: str | None = None) -> DataFrame:
        version = version or self.current()
        if version is None:
            raise ValueError(f"nothing is published in {self.path}")
        return self.spark.read.parquet(f"{self.path}/{version}/{name}")

    def _manifest(self, version: str) -> str:
        return f"{self.path}/{version}/{MANIFEST}"

    def manifest(self, version: str | None = None) -> dict[str, tuple[int, str]]:
        """(rows, content id) of the tables of a version, by name."""
        version = version or self.current()
        rows = self.spark.read.schema("name string, rows long, content string").json(self._manifest(version))
        return {r.name: (r.rows, r.content) for r in rows.collect()}  # a row a table

    @contextlib.contextmanager
    def snapshot(self, content: bool = False) -> Iterator[dict[str, DataFrame]]:
        """The tables of the current version, for a reader that must see one version whole.

        Before and after the block, the version's tables are held against its manifest, by their numbers of rows or, with
        ``content``, by all they hold if that was published. Raises :class:`TornVersion` if they differ, if a table is missing, or if the pointer has moved.
        """
        version = self.current()
        if version is None:
            raise TornVersion(f"nothing is published in {self.path}")
        said = self.manifest(version)
        self._hold(version, said, content)
        yield {name: self.read(name, version) for name in said}
        if self.current() != version:
            raise TornVersion(f"version {version} was replaced during the read")
        self._hold(version, said, content)

    def _hold(self, version: str, said: Mapping[str, tuple[int, str]], content: bool) -> None:
        for name, (rows, mark) in said.items():
            try:
                df = self.read(name, version)
                found = _counted(df) if content and mark else (df.count(), mark)
            except Exception as error:
                raise TornVersion(f"{name} of version {version} cannot be read") from error
            if found != (rows, mark):
                raise TornVersion(f"{name} of version {version} has {found[0]} rows where {rows} were published, or other ones")

    def publish(
        self, tables: Mapping[str, DataFrame], checks: Callable[[Mapping[str, DataFrame]], object] | None = None,
        version: str | None = None, before: Callable[[str], None] | None = None, content: bool = False,
    ) -> str:
        """Writes all tables, checks what was written, then moves the pointer. ``before(step)`` is a hook for fault tests.

        The manifest counts rows, which costs no scan; ``content`` reads what was written once more, for ids of what it holds.

        Publishing the version that is current already changes nothing.
        """
        version = version or uuid.uuid4().hex
        if version == self.current():
            return version
        for name, df in tables.items():
            if before:
                before(name)
            df.write.mode("overwrite").parquet(f"{self.path}/{version}/{name}")
        written = {name: self.read(name, version) for name in tables}
        if checks:
            checks(written)
        rows = [(name, *(_counted(df) if content else (df.count(), ""))) for name, df in written.items()]
        self.spark.createDataFrame(rows, "name string, rows long, content string").coalesce(1).write.mode("overwrite").json(self._manifest(version))
        if before:
            before("pointer")
        fs, path = self._pointer()
        draft = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/CURRENT.{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        out.write(bytearray(version.encode()))
        out.close()
        if before:
            before("rename")
        # one step that replaces the pointer: at any time there is an old one or a new one
        jvm = self.spark._jvm
        overwrite = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(fs.makeQualified(draft), fs.makeQualified(path), overwrite)
        return version


def _counted(df: DataFrame) -> tuple[int, str]:
    """Rows of a table and a mark of what they hold, whatever their order: a sum of hashes."""
    row = F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256)
    number = F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(38,0)")
    return tuple(df.select(number.alias("v")).agg(F.count("v"), F.coalesce(F.sum("v"), F.lit(0)).cast("string")).first())


def content_id(*tables: DataFrame) -> str:
    """A version name from what tables hold, whatever the order of their rows."""
    return uuid.uuid5(uuid.NAMESPACE_URL, "|".join(f"{n}:{total}" for n, total in map(_counted, tables))).hex

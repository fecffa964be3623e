"""The monitoring collector: a journal of metric events, and windows, signals and transitions kept up by what is new. T-9, T-11, T-12, T-15, T-16.

What grows is stored by span of event time, a day or an hour, and by pass, and only added to: ``journal/span=/pass=``,
``windows/span=/pass=``, ``rejected/pass=``, ``transitions/pass=``. A pass reads the journal of those spans only that new or late
events touch, computes the windows of these spans anew and writes them as partitions of its own number, with dynamic overwrite, so that a pass that is
repeated after a crash replaces what it left. What a pass makes valid is a small version behind a pointer: the cursors of the
sources, the digest of the registry, the counts, the pass that holds the windows of each span, and the active signals. Cursors and
tables therefore move in one step.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import alerts, metrics
from millrace.plans.publish import TornVersion, VersionedTables, content_id
from millrace.plans.staging import Scratch
from millrace.sources import byte_log, tables

STATE = "monitoring-collector-state-v1"
_SNAPSHOTS = uuid.uuid5(uuid.NAMESPACE_URL, "millrace/monitoring-snapshot")
#: Rows of one file of a partition, about.
FILE_ROWS = 100_000
_INDEX = "span string, pass int, windows long"
_STATE = "schema_version string, snapshot_id string, registry_sha256 string, accepted_events long, rejected_events long, cursors map<string,string>, pass int"


class StaleState(RuntimeError):
    """The committed state does not fit the sources, the registry or the tables; they have to be processed anew on purpose."""


@dataclass(frozen=True)
class State:
    number: int = 0
    snapshot_id: str = ""
    registry_sha256: str | None = None
    accepted: int = 0
    rejected: int = 0
    cursors: Mapping[str, str] | None = None


class MonitoringStore:
    """``span``: how the event time names a partition, ``yyyyMMdd`` for days or ``yyyyMMddHH`` for hours; the same for all passes."""

    def __init__(self, spark: SparkSession, path: str, span: str = "yyyyMMdd"):
        self.spark, self.path, self.span = spark, path.rstrip("/"), span
        self.versions = VersionedTables(spark, f"{self.path}/versions")

    def _span_of(self, time: str) -> Column:
        return F.date_format(time, self.span)

    # ---- reading

    def state(self) -> State:
        """What the last pass has committed."""
        if self.versions.current() is None:
            return State()
        r = self.versions.read("state").first()
        if r.schema_version != STATE:
            raise StaleState(f"collector state of schema {r.schema_version}")
        return State(r["pass"], r.snapshot_id, r.registry_sha256, r.accepted_events, r.rejected_events, r.cursors or {})

    def _part(self, name: str, upto: int) -> DataFrame | None:
        """The rows of passes up to a number, or None before the first."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/*=*")):
            return None
        typed = self.spark.read.option("basePath", f"{self.path}/{name}").parquet(f"{self.path}/{name}")
        span = {"span": F.col("span").cast("string")} if "span" in typed.columns else {}
        return typed.filter(F.col("pass") <= upto).withColumns(span)

    def _index(self) -> DataFrame:
        return self.versions.read("windows_index") if self.versions.current() else self.spark.createDataFrame([], _INDEX)

    def read(self, name: str) -> DataFrame:
        """``journal``, ``windows``, ``rejected``, ``transitions`` or ``active`` as the last pass left them."""
        if name == "active":
            return self.versions.read("active")
        rows = self._part(name, self.state().number)
        if rows is None:
            raise ValueError(f"no pass has written {name}")
        if name == "windows":  # of each span the pass that the version names
            rows = rows.join(self._index().select("span", "pass"), ["span", "pass"], "left_semi")
        return rows.drop("span", "pass")

    def load(self) -> dict[str, DataFrame]:
        """The tables of one pass for a display. Raises :class:`TornVersion` if the windows are not those that the version counts."""
        with self.versions.snapshot(content=True) as small:
            index = small["windows_index"]
            shown = {name: self.read(name) for name in ("windows", "transitions") if self._part(name, self.state().number) is not None}
            if "windows" in shown:
                by_span = shown["windows"].groupBy(self._span_of("window_start").alias("span")).agg(F.count(F.lit(1)).alias("_found"))
                wrong = index.join(by_span, "span", "full_outer").filter(~F.col("windows").eqNullSafe(F.col("_found")))
                if wrong.head(1):
                    raise TornVersion("windows do not match the version; read again")
            return shown | {"active": small["active"], "state": small["state"]}

    def _forget(self, number: int) -> None:
        """Removes what an attempt at a pass has left that did not come to its end."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        for pattern in (f"*/span=*/pass={number}", f"*/pass={number}"):
            for status in fs.globStatus(path(f"{self.path}/{pattern}")) or []:
                fs.delete(status.getPath(), True)

    # ---- a pass

    def collect(
        self, accepted: DataFrame, rejected: DataFrame, now: datetime, cursors: Mapping[str, str] | None = None,
        registry_sha256: str | None = None, before: Callable[[str], object] | None = None,
    ) -> tuple[bool, State]:
        """Takes events and rejected lines in; returns whether anything changed, and the state.

        Events that the journal has are not added again; an event id with another payload fails the pass. ``before(step)`` is a hook
        for fault tests.
        """
        last, scratch = self.state(), Scratch(self.spark, "monitoring")
        number = last.number + 1
        step = before or (lambda name: None)
        self._forget(number)
        new = scratch.write(metrics.dedup_events(accepted), "new")
        journal = self._part("journal", last.number)
        fresh = scratch.write(new if journal is None else _unknown(new, journal.drop("span", "pass")), "fresh")
        lost = rejected.select("source", *[c for c in ("byte_offset",) if c in rejected.columns], "event_id", "reason", "line_sha256")
        identity = [c for c in ("source", "byte_offset", "line_sha256") if c in lost.columns]
        known = self._part("rejected", last.number)
        lost = lost.dropDuplicates(identity)
        lost = scratch.write(lost if known is None else lost.join(known.select(*identity), identity, "left_anti"), "rejected")
        n_fresh, n_lost = fresh.count(), lost.count()

        step("journal")
        if n_fresh:
            _add(fresh.withColumns({"span": self._span_of("event_time"), "pass": F.lit(number)}), f"{self.path}/journal", ["span", "pass"])
        step("rejected")
        if n_lost:
            _add(lost.withColumn("pass", F.lit(number)), f"{self.path}/rejected", ["pass"])
        index = self._index()
        if n_fresh:
            # a name a span; what they name is all that is read of the journal, and all that is written of the windows
            touched = [r.span for r in fresh.select(self._span_of("event_time").alias("span")).distinct().collect()]
            rows = self._part("journal", number).filter(F.col("span").isin(touched)).drop("span", "pass")
            windows = scratch.write(metrics.metric_windows(rows).withColumns({"span": self._span_of("window_start"), "pass": F.lit(number)}), "windows")
            step("windows")
            _add(windows, f"{self.path}/windows", ["span", "pass"])
            counted = windows.groupBy("span", "pass").agg(F.count(F.lit(1)).alias("windows"))
            index = scratch.write(index.filter(~F.col("span").isin(touched)).unionByName(counted), "index")
        events = self._part("journal", number)
        events = accepted.limit(0) if events is None else events.drop("span", "pass")
        active = scratch.write(alerts.evaluate(events, now), "active")
        shown = self.versions.read("active") if last.number else active.limit(0)
        moved = scratch.write(alerts.transitions(shown, active, now), "transitions")
        n_moved = moved.count()
        same = dict(cursors or {}) == dict(last.cursors or {}) and registry_sha256 == last.registry_sha256
        if last.number and not (n_fresh or n_lost or n_moved) and same:
            scratch.close()
            return False, last
        step("transitions")
        if n_moved:
            _add(moved.withColumn("pass", F.lit(number)), f"{self.path}/transitions", ["pass"])
        # named by what came before and what is new
        added = content_id(fresh.drop("observed_at"), lost, active.drop("observed_value"), moved.drop("occurred_at", "transition_id"))
        name = json.dumps([last.snapshot_id, added, sorted((cursors or {}).items()), registry_sha256])
        state = State(number, uuid.uuid5(_SNAPSHOTS, name).hex, registry_sha256, last.accepted + n_fresh, last.rejected + n_lost, dict(cursors or {}))
        row = [(STATE, state.snapshot_id, registry_sha256, state.accepted, state.rejected, state.cursors, number)]
        small = {"state": self.spark.createDataFrame(row, _STATE).coalesce(1), "windows_index": index.coalesce(1), "active": active.coalesce(1)}
        self.versions.publish(small, version=f"{number:08d}", before=step, content=True)
        scratch.close()
        return True, state

    def collect_files(
        self, pattern: str, registry: str, now: datetime, before: Callable[[str], object] | None = None, split_bytes: int = byte_log.SPLIT_BYTES
    ) -> tuple[bool, State]:
        """One pass over the JSON-lines files that match, from where the last pass committed.

        Raises :class:`StaleState` if the registry has changed, a file has gone, shrunk or got another head, or the tables hold
        less than the state says.
        """
        last = self.state()
        digest = hashlib.sha256("\n".join(r.value for r in self.spark.read.option("wholetext", True).text(registry).collect()).encode()).hexdigest()
        if last.number and last.registry_sha256 != digest:
            raise StaleState("the quarantine registry has changed since the cursors were committed")
        for name, count in (("journal", last.accepted), ("rejected", last.rejected)):
            rows = self._part(name, last.number)
            if (0 if rows is None else rows.count()) < count:
                raise StaleState(f"the {name} is behind the committed state")
        start, end = last.cursors or {}, byte_log.cursors(pattern)
        try:
            lines = byte_log.lines_between(self.spark, start, end, split_bytes)
            lines = Scratch(self.spark, "lines").write(lines, "lines")
        except Exception as error:
            if "log truncated" in str(error) or "log replaced" in str(error):
                raise StaleState(str(error)) from error
            raise
        accepted, rejected = byte_log.metric_events(lines, tables.quarantine_registry(self.spark, registry))
        return self.collect(accepted, rejected, now, end, digest, before)


def _add(rows: DataFrame, path: str, by: list[str]) -> None:
    """Puts partitions in; those of the same names are replaced, no others are touched.

    ``rows`` are those of a written table. A partition of many rows is the work of as many tasks, by a hash of its rows.
    """
    most = rows.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
    alike = F.xxhash64(*[c for c, kind in rows.dtypes if "map<" not in kind])  # those have no hash
    rows.repartition(*by, F.pmod(alike, F.lit(-(-most // FILE_ROWS) or 1))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _unknown(new: DataFrame, journal: DataFrame) -> DataFrame:
    """Events that the journal lacks. One that it has with another payload fails the read.

    Of the journal, only the rows of these ids are looked at beyond their ids.
    """
    same = [c for c in new.columns if c not in ("event_id", "observed_at")]
    mark = F.sha2(F.to_json(F.struct(*same), {"ignoreNullFields": "false"}), 256)
    old = journal.join(new.select("event_id"), "event_id", "left_semi").select("event_id", mark.alias("_old"))
    joined = new.withColumn("_mark", mark).join(old, "event_id", "left")
    message = F.concat(F.lit("conflicting payload for event_id="), F.col("event_id"))
    kept = F.when(F.col("_old").isNull(), True).when(F.col("_old") == F.col("_mark"), False).otherwise(F.raise_error(message).cast("boolean"))
    return joined.filter(kept).select(*new.columns)

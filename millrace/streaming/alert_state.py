"""The alert state machine over a stream of signals, with keyed state and timers. Survey id T-14.

A rule that keeps firing sends a signal each time it is evaluated. The stream keeps one small state a fingerprint: the severity
that is open and when it was last seen. A signal of another severity resolves the open one and opens its own; one that is not seen
again for ``patience`` is resolved by an event-time timer. Nothing is kept of fingerprints without an open alert, so that state
is bounded by what is open.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.ids import iso_millis, uuid5
from millrace.operators.alerts import TRANSITIONS

MOVES = "fingerprint string, state string, severity string, transition_order int, occurred_at timestamp"
_STATE = "severity string, last_ms long"


class AlertMachine(StatefulProcessor):
    """Rows of a fingerprint, (severity, evaluated_at), in; its OPEN and RESOLVED moves out."""

    def __init__(self, patience_ms: int):
        self.patience_ms = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", _STATE)

    def _moves(self, key, rows: list[tuple]) -> pd.DataFrame:
        columns = ["fingerprint", "state", "severity", "transition_order", "occurred_at"]
        made = pd.DataFrame([(key, *row) for row in rows], columns=columns)
        made["occurred_at"] = pd.to_datetime(made["occurred_at"], unit="ms", utc=True)
        return made.astype({"transition_order": "int32"})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        seen = pd.concat(list(rows))
        at = (pd.to_datetime(seen["evaluated_at"], utc=True) - pd.Timestamp(0, tz="UTC")) // pd.Timedelta(milliseconds=1)
        severity, last = (self.open.get() or (None, None)) if self.open.exists() else (None, None)
        out = []
        for ms, now in sorted(set(zip(at.tolist(), seen["severity"].tolist(), strict=True))):
            if last is not None and ms < last:
                continue  # later than what it would have changed
            if severity is not None and ms > last + self.patience_ms:
                out.append(("RESOLVED", severity, 0, last + self.patience_ms))
                severity = None
            if now != severity:
                if severity is not None:
                    out.append(("RESOLVED", severity, 0, ms))
                out.append(("OPEN", now, 1, ms))
            severity, last = now, ms
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.open.update((severity, last))
        self.handle.registerTimer(last + self.patience_ms)
        yield self._moves(key[0], out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.open.exists():
            severity, last = self.open.get()
            if expiredTimerInfo.getExpiryTimeInMs() >= last + self.patience_ms:
                self.open.clear()
                yield self._moves(key[0], [("RESOLVED", severity, 0, last + self.patience_ms)])

    def close(self) -> None: ...


def _named(moves: DataFrame) -> DataFrame:
    """With the deterministic id of each transition."""
    name = F.concat_ws("|", "fingerprint", "state", "severity", iso_millis(F.col("occurred_at")))
    return moves.withColumn("transition_id", uuid5(TRANSITIONS, name))


def alert_stream(signals: DataFrame, patience: timedelta, delay: str) -> DataFrame:
    """Transitions of a stream of (fingerprint, severity, evaluated_at), whose signals come at most ``delay`` late.

    Needs the state store that keeps timers: ``spark.sql.streaming.stateStore.providerClass`` set to RocksDB's provider.
    """
    machine = AlertMachine(int(patience / timedelta(milliseconds=1)))
    keyed = signals.select("fingerprint", "severity", "evaluated_at").withWatermark("evaluated_at", delay).groupBy("fingerprint")
    moves = keyed.transformWithStateInPandas(machine, outputStructType=MOVES, outputMode="Append", timeMode="EventTime")
    return _named(moves)


def alert_history(signals: DataFrame, patience: timedelta, until) -> DataFrame:
    """The transitions that :func:`alert_stream` makes of the same signals, by windows over all of them at once.

    ``until``: the time up to which silence is judged, as a literal or column; the stream's is its watermark.
    """
    along = Window.partitionBy("fingerprint").orderBy("evaluated_at", "severity")
    wait = F.expr(f"interval {int(patience.total_seconds())} seconds")
    s = signals.select("fingerprint", "severity", "evaluated_at").distinct()
    s = s.withColumns({
        "_before": F.lag("severity").over(along), "_at": F.lag("evaluated_at").over(along), "_next": F.lead("evaluated_at").over(along),
    })
    silent = F.col("_at").isNotNull() & (F.col("evaluated_at") > F.col("_at") + wait)
    changed = F.col("_before").isNull() | silent | (F.col("_before") != F.col("severity"))
    last = F.col("_next").isNull() & (F.col("evaluated_at") + wait <= until)

    def move(state: str, severity: str, order: int, at: Column) -> Column:
        return F.struct(F.lit(state).alias("state"), F.col(severity).alias("severity"), F.lit(order).alias("transition_order"), at.alias("occurred_at"))

    before = F.when(silent, F.col("_at") + wait).otherwise(F.col("evaluated_at"))
    steps = F.array_compact(F.array(
        F.when(changed & F.col("_before").isNotNull(), move("RESOLVED", "_before", 0, before)),
        F.when(changed, move("OPEN", "severity", 1, F.col("evaluated_at"))),
        F.when(last, move("RESOLVED", "severity", 0, F.col("evaluated_at") + wait)),
    ))
    return _named(s.select("fingerprint", F.explode(steps).alias("m")).select("fingerprint", "m.*"))

"""Progress of streaming queries as metric events. Survey ids T-7, A25, K7, F29.

A listener keeps the rows, the batch and the duration of each commit; batches of two sinks pair up by batch id once both
have committed. Events have deterministic ids, so a batch that is reported again is the same event.
"""

from __future__ import annotations

import json
import threading
import uuid
from datetime import datetime, timezone

from pyspark.sql.streaming import StreamingQueryListener

EVENTS = uuid.uuid5(uuid.NAMESPACE_URL, "millrace/metric-event")
SCHEMA_VERSION = "monitoring-event-v1"


def metric_event(
    component: str, metric: str, semantics: str, values: dict[str, float], run_id: str | None, dimensions: dict, at: datetime,
    status: str = "OK", identity: str | None = None,
) -> dict:
    """One event of the eleven-field envelope."""
    name = identity or json.dumps([component, metric, run_id, dimensions], sort_keys=True)

    def stamp(moment: datetime) -> str:
        return moment.astimezone(timezone.utc).isoformat(timespec="milliseconds").replace("+00:00", "Z")

    return {
        "event_id": str(uuid.uuid5(EVENTS, name)), "event_time": stamp(at), "observed_at": stamp(datetime.now(timezone.utc)),
        "component": component, "metric_name": metric, "metric_semantics": semantics, "status": status, "run_id": run_id,
        "values": values, "dimensions": dimensions, "schema_version": SCHEMA_VERSION,
    }


class CommitListener(StreamingQueryListener):
    """Keeps each query's progress by batch id; ``paired`` gives batches that all named queries have committed."""

    def __init__(self, keep: int = 10_000):
        """``keep``: batches that are held of each query, the newest."""
        self.keep = keep
        self.batches: dict[str, dict[int, dict]] = {}
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        p = event.progress
        entry = {
            "rows": p.numInputRows, "duration_ms": p.durationMs.get("triggerExecution", 0), "run_id": str(p.runId), "at": p.timestamp
        }
        with self._lock:
            own = self.batches.setdefault(p.name or str(p.id), {})
            own[p.batchId] = entry
            while len(own) > self.keep:
                del own[min(own)]

    def paired(self, *names: str) -> dict[int, dict[str, dict]]:
        with self._lock:
            common = set.intersection(*[set(self.batches.get(n, {})) for n in names]) if names else set()
            return {b: {n: self.batches[n][b] for n in names} for b in sorted(common)}

    def totals(self, name: str) -> dict[str, int]:
        with self._lock:
            own = self.batches.get(name, {})
            return {
                "input_rows": sum(b["rows"] for b in own.values()), "non_empty_batches": sum(b["rows"] > 0 for b in own.values()),
                "last_batch_id": max(own, default=-1),
            }


def batch_events(component: str, batch_id: int, counts: dict[str, int], duration_ms: int, committed_ms: int, run_id: str) -> list[dict]:
    """The three events of a committed ingest batch: quality counts, duration, commit time."""
    at = datetime.fromtimestamp(committed_ms / 1000, timezone.utc)
    where = {"batch_id": batch_id}
    quality = {
        "batch_input_rows": sum(counts.values()), "valid_count": counts.get("VALID", 0), "warning_count": counts.get("WARNING", 0),
        "invalid_count": counts.get("INVALID", 0),
    }
    return [
        metric_event(component, "quality_counts", "delta", quality, run_id, where, at),
        metric_event(component, "batch_duration", "gauge", {"duration_ms": duration_ms}, run_id, where, at),
        metric_event(component, "last_committed", "gauge", {"committed_at_epoch_ms": committed_ms}, run_id, where, at),
    ]


def run_events(component: str, totals: dict[str, int], output_rows: int, duration_ms: int, run_id: str, at: datetime) -> list[dict]:
    """The three events of an incremental run: counts, performance, checkpoint."""
    rate = totals["input_rows"] * 1000 / duration_ms if duration_ms > 0 else 0.0
    counts = {"input_rows": totals["input_rows"], "output_rows": output_rows, "non_empty_batches": totals["non_empty_batches"]}
    return [
        metric_event(component, "run_counts", "delta", counts, run_id, {}, at),
        metric_event(component, "run_performance", "gauge", {"duration_ms": duration_ms, "rows_per_second": rate}, run_id, {}, at),
        metric_event(component, "checkpoint_progress", "gauge", {"last_batch_id": totals["last_batch_id"]}, run_id, {}, at),
    ]


def append_events(path: str, events: list[dict]) -> bool:
    """Appends events to a local JSON-lines file of the driver; False if that fails, since metrics never stop a job."""
    try:
        with open(path, "a", encoding="utf-8") as f:
            f.write("".join(json.dumps(e, ensure_ascii=False, allow_nan=False) + "\n" for e in events))
        return True
    except (OSError, ValueError):
        return False

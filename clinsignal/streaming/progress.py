"""Run record of streaming queries: every micro-batch and how a run ended.

A ``RunRecorder`` is a ``StreamingQueryListener``; it writes one row per
micro-batch (rows, duration, end offsets, observed metrics) and one per run's end
with its cause: ``failed`` (with the error), ``stopped`` (through the recorder) or
``drained``.  Rows are kept in memory up to FLUSH_ROWS and appended to a table
beside the run ledger, so a report reads what a long-lived stream has done.
"""

from __future__ import annotations

import json
import threading
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from clinsignal.sources.sinks import append_alone
from clinsignal.sources.tables import read_table_or_empty

FLUSH_ROWS = 256

PROGRESS_SCHEMA = (
    "run_id string, name string, kind string, batch_id bigint, n_rows bigint, duration_ms bigint, "
    "end_offsets string, metrics string, cause string, error string, at timestamp"
)


def progress_path(root: str) -> str:
    return f"{root.rstrip('/')}/_streams"


class RunRecorder(StreamingQueryListener):
    """Writes the progress of all queries that start after ``attach`` to ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.lock = threading.Lock()
        self.rows: list[tuple] = []
        self.names: dict[str, str | None] = {}
        self.totals: dict[str, int] = {}
        self.stopping: set[str] = set()
        self.ended: dict[str, threading.Event] = {}

    # -- life cycle -----------------------------------------------------------

    def attach(self) -> RunRecorder:
        self.spark.streams.addListener(self)
        return self

    def detach(self) -> None:
        self.spark.streams.removeListener(self)
        self.flush()

    def stop(self, query: StreamingQuery) -> None:
        """Stop a query; its end is recorded as ``stopped``."""
        with self.lock:
            self.stopping.add(str(query.runId))
        query.stop()

    def wait_end(self, query: StreamingQuery, timeout_s: float = 60.0) -> bool:
        """Wait until the end of a run is recorded (events arrive after the run)."""
        seen = self._end_of(str(query.runId)).wait(timeout_s)
        self.flush()
        return seen

    def settle(self, timeout_s: float = 60.0) -> bool:
        """Wait until the end of every run that was seen to start is recorded."""
        with self.lock:
            started = list(self.names)
        seen = [self._end_of(run_id).wait(timeout_s) for run_id in started]
        self.flush()
        return all(seen)

    def _end_of(self, run_id: str) -> threading.Event:
        with self.lock:
            return self.ended.setdefault(run_id, threading.Event())

    # -- events -----------------------------------------------------------------

    def onQueryStarted(self, event) -> None:
        with self.lock:
            self.names[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        p = event.progress
        run_id = str(p.runId)
        offsets = json.dumps([s.endOffset for s in p.sources])
        metrics = json.dumps({k: v.asDict() for k, v in (p.observedMetrics or {}).items()}, default=str)
        with self.lock:
            self.totals[run_id] = self.totals.get(run_id, 0) + p.numInputRows
        self._add(run_id, "batch", p.batchId, p.numInputRows, p.batchDuration, offsets, metrics, None, None)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run_id = str(event.runId)
        cause = "failed" if event.exception else "stopped" if run_id in self.stopping else "drained"
        self._add(run_id, "end", None, self.totals.get(run_id, 0), None, None, None, cause, event.exception)
        self._end_of(run_id).set()

    # -- table --------------------------------------------------------------------

    def _add(self, run_id: str, kind: str, *values) -> None:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        with self.lock:
            self.rows.append((run_id, self.names.get(run_id), kind, *values, now))
            full = len(self.rows) >= FLUSH_ROWS
        if full:
            self.flush()

    def flush(self) -> None:
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            append_alone(self.spark.createDataFrame(rows, PROGRESS_SCHEMA), progress_path(self.root))


def read_progress(spark: SparkSession, root: str) -> DataFrame:
    """Recorded batches and ends; empty if nothing was recorded yet."""
    schema = spark.createDataFrame([], PROGRESS_SCHEMA).schema
    return read_table_or_empty(spark, progress_path(root), schema).select(*schema.names)

"""What every micro-batch did, kept beyond what the session remembers."""

from __future__ import annotations

import json
import queue
import threading
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tradeloom.sources.commits import file_system
from tradeloom.streaming.sinks import WRITTEN

SCHEMA = ("query_id string, batch_id long, started timestamp, trigger_ms long, rows_read long, rows_written long, rows_late long")
COUNTS = ("rows_read", "rows_written", "rows_late")


class ProgressLog(StreamingQueryListener):
    """Appends what each micro-batch read, wrote and dropped, and when it started, as lines of JSON.

    Register it with ``spark.streams.addListener``. The listener only queues a report; a thread of its own appends what is
    queued to one open file and flushes it, so a report costs no Spark job and no file, and a driver that is lost leaves
    all reports that were flushed. The file is closed and a new one begun by size and by age. Where the file system
    shows a file only once it is closed, files are closed every ``unseen_seconds`` instead, and so much may be lost.
    Reports arrive a little after their batch: ``settle`` waits for the last one of a query that has ended.
    """

    def __init__(self, spark: SparkSession, path: str, roll_bytes: int = 8 << 20, roll_seconds: float = 3600, unseen_seconds: float = 10):
        self.spark, self.path = spark, path
        self.roll_bytes, self.roll_seconds, self.unseen_seconds = roll_bytes, roll_seconds, unseen_seconds
        self.reported: dict[str, int] = {}
        self._queue: queue.Queue = queue.Queue()
        self._out, self._written, self._opened, self._flushes = None, 0, 0.0, True
        self._waiting: dict[str, int] = {}
        self._thread = threading.Thread(target=self._work, name="progress-log", daemon=True)
        self._thread.start()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = (p.observedMetrics or {}).get(WRITTEN)
        self._queue.put({
            "query_id": str(p.id), "batch_id": p.batchId, "started": p.timestamp, "trigger_ms": p.durationMs.get("triggerExecution"),
            "rows_read": p.numInputRows, "rows_written": observed["rows"] if observed else None,
            "rows_late": sum(op.numRowsDroppedByWatermark for op in p.stateOperators)})

    def _work(self) -> None:
        while True:
            try:
                first = self._queue.get(timeout=self.unseen_seconds)
            except queue.Empty:
                self._close_if_due()
                continue
            held = [first]
            while not self._queue.empty():
                held.append(self._queue.get())
            lines = [x for x in held if isinstance(x, dict)]
            done = [x for x in held if isinstance(x, threading.Event)]
            if lines:
                self._append(lines)
            if done:
                self._close()
                for event in done:
                    event.set()

    def _append(self, reports: list[dict]) -> None:
        if self._out is None:
            fs, file = file_system(self.spark, f"{self.path}/progress-{uuid.uuid4().hex}.json")
            if hasattr(fs, "getRawFileSystem"):  # the checksums of a local file system hold lines back
                fs = fs.getRawFileSystem()
            self._out, self._written, self._opened = fs.create(file, False), 0, time.monotonic()
            self._flushes = self._out.hasCapability("hflush")
        data = "".join(json.dumps(r) + "\n" for r in reports).encode()
        self._out.write(bytearray(data))
        self._written += len(data)
        for r in reports:
            self._waiting[r["query_id"]] = r["batch_id"]
        if self._flushes:
            self._out.hflush()
            self._report()
        self._close_if_due()

    def _report(self) -> None:
        self.reported.update(self._waiting)
        self._waiting = {}

    def _close_if_due(self) -> None:
        age = time.monotonic() - self._opened
        if self._out is not None and (self._written >= self.roll_bytes or age >= (self.roll_seconds if self._flushes else self.unseen_seconds)):
            self._close()

    def _close(self) -> None:
        if self._out is not None:
            self._out.close()
            self._out = None
        self._report()

    def flush(self, seconds: float = 60) -> None:
        """Close the open file, so that every reader sees what has been reported."""
        done = threading.Event()
        self._queue.put(done)
        if not done.wait(seconds):
            raise TimeoutError("the reports could not be written")

    def settle(self, query: StreamingQuery, seconds: float = 60) -> None:
        last, end = query.lastProgress, time.monotonic() + seconds
        while last is not None and self.reported.get(str(query.id), -1) < last["batchId"]:
            if time.monotonic() > end:
                raise TimeoutError("the report of the last micro-batch did not arrive")
            time.sleep(0.05)
        self.flush(seconds)


def progress_reports(spark: SparkSession, path: str) -> DataFrame:
    """The reports of a ``ProgressLog``, the last of each micro-batch; a line that was cut short is left out."""
    found = spark.read.schema(SCHEMA).json(path).where("query_id IS NOT NULL AND batch_id IS NOT NULL")
    columns = [c for c in found.columns if c not in ("query_id", "batch_id")]
    return found.groupBy("query_id", "batch_id").agg(F.max_by(F.struct(*columns), "started").alias("last")).select("query_id", "batch_id", "last.*")


def batch_written_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows read, written and dropped as late per micro-batch, from the table of a ``ProgressLog``.

    (query_id, batch_id, rows_read, rows_written, rows_late). A batch that was reported again counts once.
    """
    found = spark.read.schema(SCHEMA).json(path).where("query_id IS NOT NULL AND batch_id IS NOT NULL")
    return found.groupBy("query_id", "batch_id").agg(*[F.max(c).alias(c) for c in COUNTS])


def trigger_starts(spark: SparkSession, path: str, interval_ms: int) -> DataFrame:
    """When every micro-batch with rows started: (query_id, batch_id, started, rows_read, after_ms, since_ms).

    ``after_ms`` is the time since the last multiple of the interval, at which a processing-time trigger is due, ``since_ms``
    that since the micro-batch before, NULL for the first. Reports are a row each, so the window over a query is small.
    """
    ms = F.unix_millis("started")
    before = F.lag(ms).over(Window.partitionBy("query_id").orderBy("batch_id"))
    rows = progress_reports(spark, path).where("rows_read > 0")
    return rows.select("query_id", "batch_id", "started", "rows_read", (ms % interval_ms).alias("after_ms"), (ms - before).alias("since_ms"))

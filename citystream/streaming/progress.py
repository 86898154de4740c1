"""Progress of streaming queries as data: late rows, backlog, input by trigger.

``ProgressLog`` is a listener that turns each progress report into one row of a
table (appended in blocks).  ``file_backlog`` reads the log of a file source's
checkpoint: which trigger took which files, and how many were still waiting.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = ("name string, run_id string, batch_id long, input_rows long, dropped_late long, "
            "state_rows long, outstanding long, watermark string")
#: Reports kept before they are appended to the table.
BLOCK = 500


def _outstanding(source: dict) -> int | None:
    """Offsets between what a trigger took and what the source had (Kafka form:
    topic -> partition -> offset); None for sources without such offsets."""
    def offsets(value):
        value = json.loads(value) if isinstance(value, str) else value
        if not isinstance(value, dict) or not all(isinstance(v, dict) for v in value.values()):
            return None
        return {(t, p): int(o) for t, parts in value.items() for p, o in parts.items()}
    end, latest = offsets(source.get("endOffset")), offsets(source.get("latestOffset"))
    if end is None or latest is None:
        return None
    return sum(max(0, o - end.get(k, 0)) for k, o in latest.items())


def progress_row(report: dict) -> tuple:
    """One progress report (JSON form) as a row of ``PROGRESS``."""
    states = report.get("stateOperators") or []
    behind = [x for x in map(_outstanding, report.get("sources") or []) if x is not None]
    return (report.get("name"), report.get("runId"), report.get("batchId"), report.get("numInputRows"),
            sum(s.get("numRowsDroppedByWatermark", 0) for s in states),
            sum(s.get("numRowsTotal", 0) for s in states), sum(behind) if behind else None,
            (report.get("eventTime") or {}).get("watermark"))


class ProgressLog(StreamingQueryListener):
    """Writes the reports of the queries named in ``names`` (all, if none is) to a
    Parquet table below ``path``.  Use as a context: it is added to the session's
    listeners inside, and all reports are stored when it ends."""

    def __init__(self, spark: SparkSession, path: str, names: tuple[str, ...] = ()):
        self.spark, self.path, self.names = spark, path, set(names)
        self._rows: list[tuple] = []
        self._lock = threading.Lock()
        self._runs: dict[str, threading.Event] = {}

    def __enter__(self) -> "ProgressLog":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        # Reports arrive later than a query's end: wait for the runs seen.
        for done in list(self._runs.values()):
            done.wait(30)
        self.spark.streams.removeListener(self)
        self._store()

    def _store(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def started(self, query) -> None:
        """Expect the end of ``query`` before the log is closed."""
        self._runs.setdefault(str(query.runId), threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = json.loads(event.progress.json)
        if self.names and report.get("name") not in self.names:
            return
        with self._lock:
            self._rows.append(progress_row(report))
            full = len(self._rows) >= BLOCK
        if full:
            self._store()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._runs.setdefault(str(event.runId), threading.Event()).set()

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS).parquet(self.path)


def file_backlog(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """(trigger, files, outstanding) of a query on a file source: files that each
    trigger took, and files known to the log that were taken later."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/sources/{source}")
    entry = F.from_json("value", "path string, timestamp long, batchId long")
    files = (lines.where(F.col("value").startswith("{")).select(entry.alias("e")).select("e.*")
             .dropDuplicates(["path", "batchId"]))
    per = files.groupBy(F.col("batchId").alias("trigger")).agg(F.count(F.lit(1)).alias("files"))
    # One row a trigger: a small table, ordered once.
    later = Window.orderBy("trigger").rowsBetween(1, Window.unboundedFollowing)
    return per.withColumn("outstanding", F.coalesce(F.sum("files").over(later), F.lit(0).cast("long")))

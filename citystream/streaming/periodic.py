"""Periodic cumulative summary by processing-time timers in keyed state."""

from __future__ import annotations

import sys
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from citystream.streaming.ordered import use_rocksdb

_cloudpickle.register_pickle_by_value(sys.modules[__name__])


class PeriodicCount(StatefulProcessor):
    """Cumulative row count of a key, told ``interval_ms`` after the first row
    that came since it was last told; without new rows nothing is told."""

    def __init__(self, interval_ms: int):
        self.interval_ms = interval_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n long, told long, timer boolean")

    def _get(self) -> tuple[int, int, bool]:
        return tuple(self.count.get()) if self.count.exists() else (0, 0, False)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        n, told, timer = self._get()
        n += sum(len(frame) for frame in rows)
        if not timer:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.interval_ms)
        self.count.update((n, told, True))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        n, told, _ = self._get()
        self.count.update((n, n, False))
        if n != told:
            yield pd.DataFrame({"error_reason": [key[0]], "share": [key[1]],
                                "told_ms": [expiredTimerInfo.getExpiryTimeInMs()], "records": [n]})

    def close(self) -> None:
        pass


def periodic_counts(validated: DataFrame, interval_ms: int, shares: int = 8) -> DataFrame:
    """(error_reason, share, told_ms, records): cumulative counts by reason ('NONE'
    for records that passed).  A reason's rows are dealt to ``shares`` keys, so
    the most common one does not meet in one task; readers add the last count
    of each."""
    use_rocksdb(validated.sparkSession)
    rows = validated.select(F.coalesce("error_reason", F.lit("NONE")).alias("error_reason"),
                            F.pmod(F.xxhash64("event_id"), F.lit(shares)).alias("share"))
    return rows.groupBy("error_reason", "share").transformWithStateInPandas(
        PeriodicCount(interval_ms), "error_reason string, share long, told_ms long, records long",
        "append", "ProcessingTime")


def run_until(q: StreamingQuery, done: Callable[[], bool], timeout_s: float = 300.0) -> None:
    """Let a query with a periodic trigger run until ``done()``, then stop it."""
    end = time.time() + timeout_s
    while q.isActive and not done():
        if time.time() > end:
            q.stop()
            raise TimeoutError("the query did not get there in time")
        time.sleep(0.5)
    q.stop()
    if q.exception():
        raise RuntimeError(str(q.exception()))

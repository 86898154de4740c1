"""The stateful detectors in event order, with state by entity.

Rows wait in state until the watermark has passed them and then go through the
rule in (event time, event id) order.  Alerts come ``delay`` later and are the
same however the input is cut, as long as no row is later than the watermark:
those of the batch operators.

State of a key (junction / route), all ``transformWithStateInPandas``:

* ``slots``: map of time slot -> its waiting rows.  A batch reads and writes only
  the slots that its rows fall into; a slot's event-time timer releases it;
* gridlock: a value, position in the run and the last two waits;
* bunching: a map of bus -> position and last time, and a map of pair -> start of
  its timer.  A release writes the entries that it changed.  With ``silent_s``
  each bus has one event-time timer: a bus that was not seen for longer leaves
  with its pairs, whether rows of its route come or not.

So state holds the waiting rows and the buses and pairs alive, never history.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from citystream.operators.bunching import HOLD_SEC, RADIUS_M, positioned
from citystream.operators.gridlock import WAIT_LIMIT_SEC
from citystream.streaming.stateful import (ALERT_COLUMNS, BUNCHING_OUT, GRIDLOCK_OUT,
                                           GRIDLOCK_STATE, RouteFold, _gridlock_step, _with_us)

# Workers need only pandas, NumPy and Arrow (see ``stateful``).
_cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Width of a slot of waiting rows.
SLOT_SECONDS = 60


def use_rocksdb(spark: SparkSession) -> None:
    """Maps and timers need this state store; a session may have another."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _packed(rows: pd.DataFrame) -> bytes:
    t = pa.Table.from_pandas(rows, preserve_index=False)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, t.schema) as w:
        w.write_table(t)
    return out.getvalue().to_pybytes()


def _unpacked(raw: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(raw).read_pandas()


class EventOrder(StatefulProcessor):
    """Keeps rows (ts_us, event_id, ``columns``) by slot until their timer."""

    def __init__(self, columns: list[str], slot_us: int):
        self.columns, self.slot_us = ["ts_us", "event_id", *columns], slot_us

    def init(self, handle) -> None:
        self.handle = handle
        self.slots = handle.getMapState("slots", "slot long", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        for frame in rows:
            slot = frame["ts_us"].to_numpy(np.int64) // self.slot_us
            for s in np.unique(slot).tolist():
                own = frame.loc[slot == s, self.columns]
                if self.slots.containsKey((s,)):
                    held = _unpacked(self.slots.getValue((s,))[0])
                    own = pd.concat([held, own], ignore_index=True)
                else:
                    self.handle.registerTimer((s + 1) * self.slot_us // 1000)
                self.slots.updateValue((s,), (_packed(own),))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        """Release all slots that the watermark has passed, in order: the first
        timer of a batch does it, the others find nothing."""
        # Whole slots: rows before this time have all been released.
        passed = timerValues.getCurrentWatermarkInMs() * 1000 // self.slot_us * self.slot_us
        due = sorted(s for (s,) in self.slots.keys() if (s + 1) * self.slot_us <= passed)
        rows = []
        for s in due:
            rows.append(_unpacked(self.slots.getValue((s,))[0]))
            self.slots.removeKey((s,))
        out = self.release(key, pd.concat(rows, ignore_index=True) if rows else None, passed)
        if out is not None and len(out):
            yield out

    def release(self, key, rows: pd.DataFrame | None, passed_us: int) -> pd.DataFrame | None:
        raise NotImplementedError

    def close(self) -> None:
        pass


class GridlockInOrder(EventOrder):
    def __init__(self, limit: float, slot_us: int):
        super().__init__(["avg_wait_sec", "zone"], slot_us)
        self.limit = limit

    def init(self, handle) -> None:
        super().init(handle)
        self.run = handle.getValueState("run", GRIDLOCK_STATE)

    def release(self, key, rows, passed_us):
        if rows is None:
            return None
        run, w1, w2 = self.run.get() if self.run.exists() else (0, np.nan, np.nan)
        alerts, new = _gridlock_step(rows.assign(junction_id=key[0]), run, w1, w2, self.limit)
        self.run.update(new)
        return alerts


class BunchingInOrder(EventOrder):
    def __init__(self, radius_m: float, hold_us: int, silent_us: int | None, slot_us: int):
        super().__init__(["bus_id", "lat", "lon"], slot_us)
        self.radius_m, self.hold_us, self.silent_us = radius_m, hold_us, silent_us

    def init(self, handle) -> None:
        super().init(handle)
        self.buses = handle.getMapState(
            "buses", "bus string", "seq long, lat double, lon double, seen long, timer long")
        self.pairs = handle.getMapState("pairs", "bus_1 string, bus_2 string", "since long")

    def _timer(self, seen: int) -> int:
        """End in ms of the slot in which a bus last seen at ``seen`` is silent for
        too long."""
        return ((seen + self.silent_us) // self.slot_us + 1) * self.slot_us // 1000

    def release(self, key, rows, passed_us):
        old = {k[0]: tuple(v) for k, v in self.buses.iterator()}
        timers = {tuple(k): v[0] for k, v in self.pairs.iterator()}
        fold = RouteFold(key[0], {b: v[:4] for b, v in old.items()}, timers, self.radius_m,
                         self.hold_us, self.silent_us)
        alerts = fold.run(rows) if rows is not None else []
        if self.silent_us:
            fold.forget_before(passed_us)
        now = fold.buses()
        for bus in old.keys() - now.keys():
            self.buses.removeKey((bus,))
        for bus, v in now.items():
            timer = old[bus][4] if bus in old else 0
            # One timer a bus: a new one only if there is none or it is over.
            if self.silent_us and timer * 1000 <= passed_us:
                timer = self._timer(v[3])
                self.handle.registerTimer(timer)
            if (*v, timer) != old.get(bus):
                self.buses.updateValue((bus,), (*v, timer))
        new = fold.timers()
        for pair in timers.keys() - new.keys():
            self.pairs.removeKey(pair)
        for pair, since in new.items():
            if timers.get(pair) != since:
                self.pairs.updateValue(pair, (since,))
        return pd.DataFrame(alerts, columns=ALERT_COLUMNS)


def _run(rows: DataFrame, key: str, t: str, delay: str, processor: EventOrder, out: str) -> DataFrame:
    use_rocksdb(rows.sparkSession)
    src = _with_us(rows.withWatermark(t, delay), t).select(key, t, *processor.columns)
    return src.groupBy(key).transformWithStateInPandas(processor, out, "append", "EventTime")


def gridlock_ordered(signals: DataFrame, limit: float = WAIT_LIMIT_SEC, t: str = "event_time",
                     delay: str = "10 minutes", slot_s: int = SLOT_SECONDS) -> DataFrame:
    """Gridlock alerts in event order behind a ``delay`` watermark."""
    src = signals.where(F.col(t).isNotNull()).withColumn(
        "avg_wait_sec", F.coalesce(F.col("avg_wait_sec").cast("double"), F.lit(0.0)))
    return _run(src, "junction_id", t, delay, GridlockInOrder(limit, slot_s * 1_000_000), GRIDLOCK_OUT)


def bunching_ordered(gps: DataFrame, radius_m: float = RADIUS_M, hold_s: int = HOLD_SEC,
                     t: str = "event_time", delay: str = "10 minutes",
                     silent_s: int | None = None, slot_s: int = SLOT_SECONDS) -> DataFrame:
    """Bunching alerts in event order behind a ``delay`` watermark; a bus not
    seen for more than ``silent_s`` seconds of event time is forgotten."""
    processor = BunchingInOrder(radius_m, hold_s * 1_000_000,
                                silent_s and silent_s * 1_000_000, slot_s * 1_000_000)
    out = _run(positioned(gps, t), "route_id", t, delay, processor, BUNCHING_OUT)
    return out.withColumn("distance_meters", F.round("distance_meters", 2))

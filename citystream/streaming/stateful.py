"""Streaming forms of the two stateful detectors (keyed state, Arrow batches).

Each micro-batch of a key (junction / route) arrives as pandas frames and
state carries what the rule needs across batches.  Here rows are ordered by
(event time, event id) inside a micro-batch only (arrival order), so alerts
come at once but depend on how the input is cut into batches; forms that wait
for the watermark are in ``ordered``.

Rows without event time or position take no part, as in the batch forms.
Idle keys leave by a processing-time timeout.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from citystream.functions.geo import EARTH_RADIUS_M
from citystream.operators.bunching import HOLD_SEC, RADIUS_M, positioned
from citystream.operators.gridlock import RUN_LENGTH, WAIT_LIMIT_SEC

# The state functions run in Python workers.  Pickling this module's code by
# value ships it with each task, so workers need only pandas/numpy, not this
# package on their path (on a cluster, --py-files works as well).
from pyspark import cloudpickle as _cloudpickle  # noqa: E402

_cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRIDLOCK_OUT = ("junction_id string, zone string, wait_1 double, wait_2 double, "
                "wait_3 double, event_id long, event_us long")
GRIDLOCK_STATE = "run long, w1 double, w2 double"

BUNCHING_OUT = ("route_id string, bus_1 string, bus_2 string, distance_meters double, "
                "duration_seconds long, event_id long, event_us long")
BUNCHING_STATE = ("buses array<string>, lat array<double>, lon array<double>, "
                  "pair_i array<int>, pair_j array<int>, timer array<long>")


def _with_us(df: DataFrame, t: str) -> DataFrame:
    return df.withColumn("ts_us", F.unix_micros(F.col(t)))


def _gridlock_fn(limit: float, timeout_ms: int | None):
    def fn(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        pdf = pd.concat(list(frames), ignore_index=True)
        run, w1, w2 = state.get if state.exists else (0, np.nan, np.nan)
        out, new = _gridlock_step(pdf, run, w1, w2, limit)
        state.update(new)
        if timeout_ms:
            state.setTimeoutDuration(timeout_ms)
        if len(out):
            yield out
    return fn


def gridlock_stream(signals: DataFrame, limit: float = WAIT_LIMIT_SEC,
                    t: str = "event_time", timeout_ms: int | None = None) -> DataFrame:
    """Gridlock alerts from a stream (append mode).  ``t`` must be TIMESTAMP."""
    src = _with_us(signals.where(F.col(t).isNotNull()), t).select("junction_id", "zone", "avg_wait_sec", "event_id", "ts_us")
    tconf = GroupStateTimeout.ProcessingTimeTimeout if timeout_ms else GroupStateTimeout.NoTimeout
    return src.groupBy("junction_id").applyInPandasWithState(
        _gridlock_fn(limit, timeout_ms), GRIDLOCK_OUT, GRIDLOCK_STATE, "append", tconf)


def _haversine_np(lat1, lon1, lat2, lon2):
    p1, p2 = np.radians(lat1), np.radians(lat2)
    a = (np.sin(np.radians(lat2 - lat1) / 2) ** 2
         + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2)
    return EARTH_RADIUS_M * 2 * np.arctan2(np.sqrt(a), np.sqrt(1 - a))


class RouteFold:
    """The bunching rule over one route's rows in (time, id) order.

    ``buses``: bus -> (order of first sighting, lat, lon, last time in us);
    ``timers``: (bus, bus) -> start in us, the bus seen first in front.  A row
    touches only the pairs of its bus that come near or part; due timers wait in
    a heap, so a row costs one array of distances and what it changes.  With
    ``silent_us`` a bus that was not seen for longer is forgotten, with its
    timers, before the first row behind that.
    """

    def __init__(self, route, buses: dict, timers: dict, radius: float, hold_us: int,
                 silent_us: int | None = None):
        self.route, self.radius, self.hold_us, self.silent_us = route, radius, hold_us, silent_us
        known = sorted(buses.items(), key=lambda x: x[1][0])
        self.names = [b for b, _ in known]
        self.order = [v[0] for _, v in known]
        self.seen = [int(v[3]) for _, v in known]
        self.slot = {b: i for i, b in enumerate(self.names)}
        size = max(16, 2 * len(known))
        self.at = np.full((2, size), np.nan)
        for i, (_, v) in enumerate(known):
            self.at[:, i] = v[1], v[2]
        self.start: dict[tuple[int, int], int] = {}
        self.near: dict[int, set[int]] = {}
        self.due: list[tuple] = []
        for (a, b), us in timers.items():
            self._begin(*sorted((self.slot[a], self.slot[b])), int(us))
        self.quiet = [(us, i) for i, us in enumerate(self.seen)] if silent_us else []
        heapq.heapify(self.quiet)

    def _begin(self, a: int, b: int, us: int) -> None:
        self.start[a, b] = us
        self.near.setdefault(a, set()).add(b)
        self.near.setdefault(b, set()).add(a)
        heapq.heappush(self.due, (us + self.hold_us, a, b, us))

    def _part(self, i: int, j: int) -> None:
        self.start.pop((min(i, j), max(i, j)))
        self.near[i].discard(j)
        self.near[j].discard(i)

    def forget_before(self, us: int) -> None:
        """Forget buses whose last time lies more than ``silent_us`` before."""
        while self.quiet and self.quiet[0][0] + self.silent_us < us:
            seen, i = heapq.heappop(self.quiet)
            if self.seen[i] != seen:
                heapq.heappush(self.quiet, (self.seen[i], i))
                continue
            for j in list(self.near.get(i, ())):
                self._part(i, j)
            self.at[:, i] = np.nan
            del self.slot[self.names[i]]

    def run(self, rows: pd.DataFrame) -> list[tuple]:
        """Alerts (route, bus_1, bus_2, distance, duration_s, event_id, event_us)
        of rows (bus_id, lat, lon, event_id, ts_us); distances are not rounded."""
        out = []
        rows = rows.sort_values(["ts_us", "event_id"])
        for bus, la, lo, eid, us in zip(rows["bus_id"], rows["lat"], rows["lon"],
                                        rows["event_id"], rows["ts_us"]):
            if la is None or lo is None or np.isnan(la) or np.isnan(lo):
                continue
            us = int(us)
            if self.silent_us:
                self.forget_before(us)
            i = self.slot.get(bus)
            if i is None:
                i = self.slot[bus] = len(self.names)
                self.names.append(bus)
                self.order.append(self.order[-1] + 1 if self.order else 0)
                self.seen.append(us)
                if i == self.at.shape[1]:
                    self.at = np.hstack([self.at, np.full((2, i), np.nan)])
                if self.silent_us:
                    heapq.heappush(self.quiet, (us, i))
            self.at[:, i], self.seen[i] = (la, lo), us
            d = _haversine_np(self.at[0, :len(self.names)], self.at[1, :len(self.names)], la, lo)
            now = set(np.flatnonzero(d <= self.radius).tolist()) - {i}
            had = self.near.get(i, set())
            for j in had - now:
                self._part(i, j)
            for j in now - had:
                self._begin(min(i, j), max(i, j), us)
            again = []
            while self.due and self.due[0][0] <= us:
                _, a, b, start = heapq.heappop(self.due)
                # A timer set by this row has run for nothing yet.
                if self.start.get((a, b)) != start:
                    continue
                dist = float(_haversine_np(*self.at[:, a], *self.at[:, b]))
                out.append((self.route, self.names[a], self.names[b], dist,
                            (us - start) // 1_000_000, int(eid), us))
                again.append((a, b))
            for a, b in again:
                self._begin(a, b, us)
        return out

    def buses(self) -> dict:
        return {b: (self.order[i], float(self.at[0, i]), float(self.at[1, i]), self.seen[i])
                for b, i in self.slot.items()}

    def timers(self) -> dict:
        return {(self.names[a], self.names[b]): us for (a, b), us in self.start.items()}


def bunch_events(route, pdf: pd.DataFrame, buses: list, lat: list, lon: list,
                 timers: dict, radius: float, hold_us: int) -> list[tuple]:
    """Run the rule over one route's events; ``buses``/``lat``/``lon`` (order of
    first sighting) and ``timers`` ((i, j) slots -> start, us) are the route's
    state as arrays and are updated in place."""
    fold = RouteFold(route, {b: (i, lat[i], lon[i], 0) for i, b in enumerate(buses)},
                     {(buses[a], buses[b]): us for (a, b), us in timers.items()}, radius, hold_us)
    rows = fold.run(pdf)
    n = len(fold.names)
    buses[:], lat[:], lon[:] = fold.names, fold.at[0, :n].tolist(), fold.at[1, :n].tolist()
    timers.clear()
    timers.update(fold.start)
    return rows


ALERT_COLUMNS = ["route_id", "bus_1", "bus_2", "distance_meters", "duration_seconds",
                 "event_id", "event_us"]


def _bunching_fn(radius: float, hold_us: int, timeout_ms: int | None):
    def fn(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        pdf = pd.concat(list(frames), ignore_index=True)
        if state.exists:
            buses, lat, lon, pi, pj, tm = state.get
            buses, lat, lon = list(buses), list(lat), list(lon)
            timers = {(int(a), int(b)): int(c) for a, b, c in zip(pi, pj, tm)}
        else:
            buses, lat, lon, timers = [], [], [], {}
        rows = bunch_events(key[0], pdf, buses, lat, lon, timers, radius, hold_us)
        items = sorted(timers.items())
        state.update((buses, lat, lon, [a for (a, _), _ in items],
                      [b for (_, b), _ in items], [v for _, v in items]))
        if timeout_ms:
            state.setTimeoutDuration(timeout_ms)
        if rows:
            yield pd.DataFrame(rows, columns=ALERT_COLUMNS)
    return fn


def bunching_stream(gps: DataFrame, radius_m: float = RADIUS_M, hold_s: int = HOLD_SEC,
                    t: str = "event_time", timeout_ms: int | None = None) -> DataFrame:
    """Bunching alerts from a stream (append mode), keyed by route."""
    src = _with_us(positioned(gps, t), t).select("route_id", "bus_id", "lat", "lon", "event_id", "ts_us")
    tconf = GroupStateTimeout.ProcessingTimeTimeout if timeout_ms else GroupStateTimeout.NoTimeout
    out = src.groupBy("route_id").applyInPandasWithState(
        _bunching_fn(radius_m, hold_s * 1_000_000, timeout_ms), BUNCHING_OUT,
        BUNCHING_STATE, "append", tconf)
    return out.withColumn("distance_meters", F.round("distance_meters", 2))


# --- transformWithStateInPandas forms (Spark 4 API, state TTL) --------------

def _gridlock_step(pdf: pd.DataFrame, run: int, w1: float, w2: float, limit: float):
    """Vectorised gridlock rule over one key's batch; returns (alerts, state)."""
    pdf = pdf.sort_values(["ts_us", "event_id"])
    w = pdf["avg_wait_sec"].astype("float64").fillna(0.0).to_numpy()
    high = w > limit
    idx = np.arange(len(w))
    last_low = np.maximum.accumulate(np.where(~high, idx, -1))
    pos = np.where(last_low >= 0, idx - last_low, idx + 1 + run)
    alert = high & (pos % RUN_LENGTH == 0)
    prev = np.concatenate([[w2, w1], w])
    out = pdf.loc[alert, ["junction_id", "zone", "event_id", "ts_us"]].copy()
    ai = idx[alert] + 2
    out["wait_1"], out["wait_2"], out["wait_3"] = prev[ai - 2], prev[ai - 1], prev[ai]
    state = (int(pos[-1] % RUN_LENGTH) if high[-1] else 0, float(prev[-1]), float(prev[-2]))
    return out.rename(columns={"ts_us": "event_us"})[
        ["junction_id", "zone", "wait_1", "wait_2", "wait_3", "event_id", "event_us"]], state


class GridlockProcessor:
    """Keyed by junction: ValueState (run position mod 3, last two waits),
    expiring after ``ttl_ms`` without updates."""

    def __new__(cls, limit: float = WAIT_LIMIT_SEC, ttl_ms: int | None = None):
        from pyspark.sql.streaming.stateful_processor import StatefulProcessor

        class _P(StatefulProcessor):
            def init(self, handle):
                self.state = handle.getValueState("gridlock", GRIDLOCK_STATE, ttl_ms)

            def handleInputRows(self, key, rows, timerValues):
                pdf = pd.concat(list(rows), ignore_index=True)
                run, w1, w2 = self.state.get() if self.state.exists() else (0, np.nan, np.nan)
                out, new = _gridlock_step(pdf, run, w1, w2, limit)
                self.state.update(new)
                if len(out):
                    yield out

            def close(self):
                pass
        return _P()


class BunchingProcessor:
    """Keyed by route: ValueState (buses in first-sighting order, positions,
    pair timers), expiring after ``ttl_ms`` without updates."""

    def __new__(cls, radius_m: float = RADIUS_M, hold_s: int = HOLD_SEC,
                ttl_ms: int | None = None):
        from pyspark.sql.streaming.stateful_processor import StatefulProcessor
        hold_us = hold_s * 1_000_000

        class _P(StatefulProcessor):
            def init(self, handle):
                self.state = handle.getValueState("bunching", BUNCHING_STATE, ttl_ms)

            def handleInputRows(self, key, rows, timerValues):
                pdf = pd.concat(list(rows), ignore_index=True)
                if self.state.exists():
                    buses, lat, lon, pi, pj, tm = self.state.get()
                    buses, lat, lon = list(buses), list(lat), list(lon)
                    timers = {(int(a), int(b)): int(c) for a, b, c in zip(pi, pj, tm)}
                else:
                    buses, lat, lon, timers = [], [], [], {}
                out = bunch_events(key[0], pdf, buses, lat, lon, timers, radius_m, hold_us)
                items = sorted(timers.items())
                self.state.update((buses, lat, lon, [a for (a, _), _ in items],
                                   [b for (_, b), _ in items], [v for _, v in items]))
                if out:
                    yield pd.DataFrame(out, columns=ALERT_COLUMNS)

            def close(self):
                pass
        return _P()


def gridlock_stream_tws(signals: DataFrame, limit: float = WAIT_LIMIT_SEC,
                        t: str = "event_time", ttl_ms: int | None = None) -> DataFrame:
    """Gridlock through ``transformWithStateInPandas`` (needs the RocksDB
    state store); state of a silent junction expires after ``ttl_ms``."""
    src = _with_us(signals.where(F.col(t).isNotNull()), t).select("junction_id", "zone", "avg_wait_sec", "event_id", "ts_us")
    return src.groupBy("junction_id").transformWithStateInPandas(
        GridlockProcessor(limit, ttl_ms), GRIDLOCK_OUT, "append",
        "ProcessingTime" if ttl_ms else "None")


def bunching_stream_tws(gps: DataFrame, radius_m: float = RADIUS_M, hold_s: int = HOLD_SEC,
                        t: str = "event_time", ttl_ms: int | None = None) -> DataFrame:
    """Bunching through ``transformWithStateInPandas``, keyed by route."""
    src = _with_us(positioned(gps, t), t).select("route_id", "bus_id", "lat", "lon", "event_id", "ts_us")
    out = src.groupBy("route_id").transformWithStateInPandas(
        BunchingProcessor(radius_m, hold_s, ttl_ms), BUNCHING_OUT, "append",
        "ProcessingTime" if ttl_ms else "None")
    return out.withColumn("distance_meters", F.round("distance_meters", 2))

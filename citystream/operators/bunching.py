"""Bus bunching: two buses of one route stay within 200 m for 300 s.

Rule per route, in event order: each event moves its bus; then every pair
of buses on the route is checked at their latest positions.  Within the
radius, a pair starts a timer at the first such event ("tick") and raises an
incident at the first tick at least the hold time later, restarting the
timer there; leaving the radius clears the timer.  Rows without a usable
position or time (null or NaN) are skipped: they neither move a bus nor count
as a tick.  Feed validated rows.

Batch form, the same for every size, without gathering a route in one place:
 1. each position is valid from its tick to the bus's next tick
    (``keyed_neighbor`` over (route, bus), sliced by time);
 2. near pairs: positions are bucketed by (route, time bucket, sphere cell),
    one side widened to the 14 forward neighbour cells, equi-joined, then filtered
    on exact interval overlap and haversine distance.  No pair further than
    two cells apart is ever formed;
 3. touching near segments of a pair merge into islands (sliced lag/fill);
 4. the alert chain of each island (from its first tick on always the first
    route tick at least ``hold`` later, while before its end), by composing
    slices of time (``plans.chain``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citystream.functions.geo import (cell_in_reach, haversine_m, neighbour_cells, sphere_cells,
                                     unit_vector)
from citystream.functions.time import epoch_micros, split_id
from citystream.operators.incidents import BUS_BUNCHING, MEDIUM
from citystream.plans import chain
from citystream.plans.sequence import (DEFAULT_SPLIT_SECONDS, keyed_fill, keyed_neighbor,
                                      order_key)
from citystream.session import cut

# Bunching radius (metres, inclusive) and hold time (seconds).
RADIUS_M = 200.0
HOLD_SEC = 300

PAIR = ["route_id", "bus_a", "bus_b"]


def _tick(t: str = "t", e: str = "e"):
    return order_key(t, e)


def positioned(gps: DataFrame, t: str = "event_time") -> DataFrame:
    """Rows with a time and a real position (streams use the same filter)."""
    def real(c: str):
        return F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return gps.where(real("lat") & real("lon") & F.col(t).isNotNull())


def route_stats(g: DataFrame) -> dict:
    """One aggregate job sizing every later step: rows of the largest route,
    rows, buses (approximate distinct is enough for sizing) and time span."""
    per_route = g.groupBy("route_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.approx_count_distinct("bus_id").alias("b"),
        F.min(epoch_micros("t")).alias("lo"), F.max(epoch_micros("t")).alias("hi"))
    r = per_route.agg(F.max("n").alias("max_route"), F.sum("n").alias("n"),
                      F.sum("b").alias("b"), F.min("lo").alias("lo"),
                      F.max("hi").alias("hi")).first()
    return r.asDict() if r and r["n"] else {"max_route": 0, "n": 0, "b": 0, "lo": 0, "hi": 0}


def pair_bucket_seconds(g: DataFrame, stats: dict | None = None) -> int:
    """Time-bucket width for the pair join: about two typical position gaps.

    Copies of a position interval grow as interval / width, and candidate
    pairs per (route, bucket, cell) grow with width * rate; two gaps keeps
    both near a handful per bus.
    """
    r = stats or route_stats(g)
    if not r["n"]:
        return 3600
    gap = (r["hi"] - r["lo"]) / 1e6 * max(r["b"], 1) / r["n"]
    return int(min(max(2 * gap, 1), 86400))


def slice_seconds_for(stats: dict) -> int:
    """Scan slice width so the busiest route holds ~TARGET_SLICE_ROWS per slice."""
    from citystream.plans.sequence import MAX_SLICE_SECONDS, TARGET_SLICE_ROWS
    if not stats["max_route"]:
        return DEFAULT_SPLIT_SECONDS
    span = max((stats["hi"] - stats["lo"]) / 1e6, 1.0)
    return int(min(max(span * TARGET_SLICE_ROWS / stats["max_route"], 1), MAX_SLICE_SECONDS))


# Fan-out of the bucket levels: an interval lives on the level where it spans
# at most this many buckets (widths W, W*K, W*K^2, ...).
LEVEL_FANOUT = 16
UNIT = ["_ux", "_uy", "_uz"]


def _spread(rows: DataFrame, radius_m: float, forward: bool) -> DataFrame:
    """A copy of each interval for each neighbour cell that can hold a near one."""
    cells = neighbour_cells(F.col("cx"), F.col("cy"), F.col("cz"), forward)
    return (rows.withColumn("_nc", F.explode(cells))
            .where(cell_in_reach([F.col(f"_nc.{c}") for c in ("cx", "cy", "cz")],
                                 [F.col(c) for c in UNIT], radius_m))
            .select("route_id", "_pb", F.col("_nc.cx").alias("cx"),
                    F.col("_nc.cy").alias("cy"), F.col("_nc.cz").alias("cz"),
                    F.col("_nc.own").alias("own"), F.col("bus_id").alias("bus_p"),
                    F.col("lat").alias("lat_p"), F.col("lon").alias("lon_p"),
                    F.col("s").alias("s_p"), F.col("f").alias("f_p")))


def near_segments(g: DataFrame, radius_m: float = RADIUS_M,
                  seconds: int = DEFAULT_SPLIT_SECONDS,
                  pair_seconds: int | None = None) -> DataFrame:
    """Maximal tick ranges over which two buses of a route are within radius.

    In: route_id, bus_id, lat, lon, t, e.  Out: route_id, bus_a < bus_b,
    s (first tick), f (exclusive end tick, null = open), dist.

    Each position is valid from its tick to its bus's next tick.  Intervals
    are matched through an equi-join on (route, time bucket, sphere cell).
    So that a long interval (a silent bus, a final open position) does not
    become one copy per fine bucket, intervals are put on levels: level k
    uses buckets of width W*K^k and holds intervals spanning at most K+1 of
    them.  At level j two joins meet in level-j buckets (at most K+1 copies of
    an interval): level j with itself, over the forward neighbour cells, and
    level j with levels < j, over all neighbour cells of the longer intervals.
    One side is always the few intervals of that length, and only that side is
    copied to neighbour cells, so short intervals never meet each other in wide
    buckets and go into each of them once.  A pair is kept in the bucket holding the
    start of its overlap: every overlapping pair exactly once.
    """
    pb_w = pair_seconds or pair_bucket_seconds(g)
    k = LEVEL_FANOUT
    pos = keyed_neighbor(g, ["route_id", "bus_id"], "t", "e", ["t", "e"], "nx",
                         step=1, seconds=seconds)
    last = g.groupBy("route_id").agg(F.max(_tick()).alias("_last"))
    pos = pos.join(last, "route_id")
    s_us = epoch_micros("t")
    end_us = epoch_micros(F.coalesce(F.col("nx.t"), F.col("_last.t")))
    span = (end_us - s_us).cast("double")
    base = float(pb_w) * 1e6 * k
    level = F.when(span <= F.lit(base), F.lit(0)).otherwise(
        F.ceil(F.log(span / F.lit(base)) / F.lit(math.log(k)) + F.lit(1e-9))).cast("int")
    cx, cy, cz = sphere_cells(F.col("lat"), F.col("lon"), radius_m)
    pos = cut(pos.select(
        "route_id", "bus_id", "lat", "lon", _tick().alias("s"), F.col("nx").alias("f"),
        s_us.alias("_su"), end_us.alias("_eu"), level.alias("_lv"),
        cx.alias("cx"), cy.alias("cy"), cz.alias("cz"),
        *[x.alias(n) for n, x in zip(UNIT, unit_vector(F.col("lat"), F.col("lon")))]))
    # Distinct levels: a few small integers (log_K of the longest interval).
    levels = sorted(r[0] for r in pos.select("_lv").distinct().collect())
    parts = []
    for lv in levels:
        width = int(pb_w * 1_000_000 * k ** lv)
        rows = pos.where(F.col("_lv") <= lv).withColumn(
            "_pb", F.explode(F.sequence(F.floor(F.col("_su") / width),
                                        F.floor(F.col("_eu") / width))))
        single = rows.select("route_id", "_pb", "cx", "cy", "cz", F.col("bus_id").alias("bus_q"),
                        F.col("lat").alias("lat_q"), F.col("lon").alias("lon_q"),
                        F.col("s").alias("s_q"), F.col("f").alias("f_q"),
                        F.col("_lv").alias("lv_q"))
        on = ["route_id", "_pb", "cx", "cy", "cz"]
        long_ = rows.where(F.col("_lv") == lv)
        j = (_spread(long_, radius_m, forward=True).join(single.where(F.col("lv_q") == lv), on)
             .where((F.col("bus_p") < F.col("bus_q"))
                    | (~F.col("own") & (F.col("bus_p") > F.col("bus_q")))))
        if lv > levels[0]:
            j = j.unionByName(_spread(long_, radius_m, forward=False)
                              .join(single.where(F.col("lv_q") < lv), on)
                              .where(F.col("bus_p") != F.col("bus_q")))
        s = F.greatest("s_p", "s_q")
        f = F.least("f_p", "f_q")  # least skips nulls: null only when both are open
        j = j.select("route_id", F.least("bus_p", "bus_q").alias("bus_a"),
                     F.greatest("bus_p", "bus_q").alias("bus_b"), "_pb", s.alias("s"),
                     f.alias("f"),
                     haversine_m(F.col("lat_p"), F.col("lon_p"), F.col("lat_q"), F.col("lon_q"))
                     .alias("dist"))
        parts.append(j.where((F.col("f").isNull() | (F.col("s") < F.col("f")))
                             & (F.col("_pb") == F.floor(epoch_micros(F.col("s.t")) / width))
                             & (F.col("dist") <= F.lit(float(radius_m))))
                      .drop("_pb"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def islands(seg: DataFrame, seconds: int = DEFAULT_SPLIT_SECONDS) -> DataFrame:
    """Merge touching segments of a pair: (route_id, bus_a, bus_b, s, f)."""
    seg = seg.withColumn("_st", F.col("s.t")).withColumn("_se", F.col("s.e"))
    prev = keyed_neighbor(seg, PAIR, "_st", "_se", ["f"], "_prev", step=-1, seconds=seconds)
    starts = F.when(F.col("_prev").isNull() | (F.col("_prev.f") != F.col("s")), F.col("s"))
    filled = keyed_fill(prev, PAIR, [F.col("_st"), F.col("_se")], split_id("_st", seconds),
                        starts, "island")
    return (filled.groupBy(*PAIR, "island")
            .agg(F.when(F.count(F.lit(1)) == F.count("f"), F.max("f")).alias("f"))
            .withColumnRenamed("island", "s"))


def bunching(gps: DataFrame, radius_m: float = RADIUS_M, hold_s: int = HOLD_SEC,
             t: str = "event_time", e: str = "event_id",
             seconds: int | None = None,
             pair_seconds: int | None = None) -> DataFrame:
    """Bunching incidents from a batch of GPS rows.

    Out: incident_type, severity, route_id, bus_1, bus_2 (bus_1 = the one seen
    first on the route), distance_meters (2 dp), duration_seconds, event_id,
    event_time (the alert tick), details (struct).

    No plan gathers a route; ``event_id`` needs to be unique only within a
    route and time.
    """
    # Cleaned rows are read by several phases: cut them once.
    g = cut(positioned(gps, t)
            .select("route_id", "bus_id", F.col("lat").cast("double").alias("lat"),
                    F.col("lon").cast("double").alias("lon"),
                    F.col(t).cast("timestamp_ntz").alias("t"), F.col(e).cast("long").alias("e")))
    stats = route_stats(g)
    # Slices sized for the busiest route, the widest key of every scan below.
    seconds = seconds or slice_seconds_for(stats)
    pair_seconds = pair_seconds or pair_bucket_seconds(g, stats)
    # Tables in the shared folder cut the lineage between phases.
    seg = cut(near_segments(g, radius_m, seconds, pair_seconds))

    # Islands that last the hold time at all, and the ticks of their routes.
    last = g.groupBy("route_id").agg(F.max("t").alias("_lt"))
    lasts = (epoch_micros(F.coalesce(F.col("f.t"), F.col("_lt"))) - epoch_micros(F.col("s.t")))
    isl = (islands(seg, seconds).join(last, "route_id")
           .where(lasts >= F.lit(hold_s * 1_000_000)).drop("_lt"))
    steps = chain.steps(g.select("route_id", "t", "e"), isl, PAIR + ["s"], hold_s, seconds)

    # Distance at the alert tick: the pair's segment starting at or before it.
    seg_rows = seg.select(*PAIR, F.col("s.t").alias("_t"), F.col("s.e").alias("_e"),
                          F.lit(0).alias("_k"), "dist",
                          F.lit(None).cast("struct<t:timestamp_ntz,e:bigint>").alias("prev"),
                          F.lit(None).cast("struct<t:timestamp_ntz,e:bigint>").alias("at"))
    alert_rows = steps.select(*PAIR, F.col("at.t").alias("_t"), F.col("at.e").alias("_e"),
                              F.lit(1).alias("_k"), F.lit(None).cast("double").alias("dist"),
                              "prev", "at")
    both = seg_rows.unionByName(alert_rows)
    filled = keyed_fill(both, PAIR, [F.col("_t"), F.col("_e"), F.col("_k")],
                        split_id("_t", seconds), F.col("dist"), "_d")
    alerts = filled.where(F.col("_k") == 1)

    first = g.groupBy("route_id", "bus_id").agg(F.min(_tick()).alias("_first"))
    fa = first.select("route_id", F.col("bus_id").alias("bus_a"), F.col("_first").alias("_fa"))
    fb = first.select("route_id", F.col("bus_id").alias("bus_b"), F.col("_first").alias("_fb"))
    alerts = alerts.join(fa, ["route_id", "bus_a"]).join(fb, ["route_id", "bus_b"])
    a_first = F.col("_fa") < F.col("_fb")
    dur = ((epoch_micros(F.col("at.t")) - epoch_micros(F.col("prev.t"))) / F.lit(1_000_000)
           ).cast("long")
    return _finish(alerts.select(
        "route_id", F.when(a_first, F.col("bus_a")).otherwise(F.col("bus_b")).alias("bus_1"),
        F.when(a_first, F.col("bus_b")).otherwise(F.col("bus_a")).alias("bus_2"),
        F.col("_d").alias("distance_meters"), dur.alias("duration_seconds"), "at"))


def _finish(alerts: DataFrame) -> DataFrame:
    """Common output shape: (route_id, bus_1, bus_2, distance, duration, at)."""
    dist = F.round("distance_meters", 2)
    return alerts.select(
        F.lit(BUS_BUNCHING).alias("incident_type"), F.lit(MEDIUM).alias("severity"),
        "route_id", "bus_1", "bus_2", dist.alias("distance_meters"),
        F.col("duration_seconds").cast("long").alias("duration_seconds"),
        F.col("at.e").alias("event_id"), F.col("at.t").alias("event_time"),
        F.struct("route_id", "bus_1", "bus_2", dist.alias("distance_meters"),
                 F.col("duration_seconds").cast("long").alias("duration_seconds"))
        .alias("details"))


def latest_positions(gps: DataFrame, t: str = "event_time", e: str = "event_id") -> DataFrame:
    """Last known position of every bus on every route (ties by event id).

    ``max_by`` over a (time, id) struct is an aggregate with a map-side
    partial step, so a bus with many rows is never gathered in one place.
    Rows without a usable position or time are skipped.
    """
    g = positioned(gps, t)
    last = F.max_by(F.struct("lat", "lon", F.col(t).alias("t"), F.col(e).alias("e")),
                    order_key(t, e))
    return (g.groupBy("route_id", "bus_id").agg(last.alias("_p"))
             .select("route_id", "bus_id", F.col("_p.lat").alias("lat"),
                     F.col("_p.lon").alias("lon"), F.col("_p.e").alias("event_id"),
                     F.col("_p.t").alias("event_time")))

"""Bus bunching: batch (cell join + islands + doubling) equals the event fold."""
import datetime as dt
import math
import random

from citystream.operators.bunching import bunching
from tests.folds import bunching_fold

T0 = dt.datetime(2024, 1, 1)
M_LAT = 1.0 / 111194.93  # degrees of latitude per metre (R = 6371 km)


def _frame(spark, rows):
    data = [(b, r, la, lo, T0 + dt.timedelta(microseconds=t), e) for r, b, t, e, la, lo in rows]
    return spark.createDataFrame(
        data, "bus_id string, route_id string, lat double, lon double, "
              "event_time timestamp_ntz, event_id long")


def _alerts(df):
    return sorted((r.route_id, r.bus_1, r.bus_2, r.distance_meters, r.duration_seconds,
                   r.event_id) for r in df.collect())


def _batch(spark, rows, **kw):
    return _alerts(bunching(_frame(spark, rows), **kw))


def test_edges(spark):
    s = 1_000_000
    base = 19.0
    rows = [
        # 200 m apart exactly-ish vs just above: only the first pair bunches
        ("R1", "B1", 0, 1, base, 72.9), ("R1", "B2", 1 * s, 2, base + 199.99 * M_LAT, 72.9),
        ("R1", "B1", 299 * s, 3, base, 72.9),          # 299 s: no alert yet
        ("R1", "B2", 300 * s, 4, base + 199.99 * M_LAT, 72.9),  # 299 s after timer start (1 s)
        ("R1", "B3", 301 * s, 5, 19.5, 73.4),          # third bus far away: its tick alerts
        ("R1", "B2", 500 * s, 6, base + 250 * M_LAT, 72.9),     # separates: timer cleared
        ("R1", "B2", 600 * s, 7, base + 10 * M_LAT, 72.9),      # returns: new timer
        ("R1", "B1", 900 * s, 8, base, 72.9),          # 300 s later: alert
        # same bus ids on another route never pair with route R1
        ("R2", "B1", 0, 9, base, 72.9), ("R2", "B9", 0, 10, base + 201 * M_LAT, 72.9),
        ("R2", "B9", 400 * s, 11, base + 1 * M_LAT, 72.9), ("R2", "B1", 700 * s, 12, base, 72.9),
        ("R1", "B4", 950 * s, 13, None, 72.9),         # null position: skipped entirely
    ]
    expect = bunching_fold(rows)
    assert sorted(e[-1] for e in expect) == [5, 8, 12]
    assert _batch(spark, rows) == expect
    assert _batch(spark, rows, seconds=60) == expect


def test_long_silent_bus_uses_levels(spark):
    # B1 parks for a long time; others pass by it much later.  With 10-second
    # pair buckets its interval spans hundreds of buckets and lands on a
    # higher level; results must not change.
    s = 1_000_000
    rows = [("R1", "B1", 0, 1, 19.0, 72.9), ("R1", "B2", 5 * s, 2, 19.01, 72.9)]
    eid = 3
    for i in range(1, 60):
        rows.append(("R1", "B2", (5 + 100 * i) * s, eid, 19.0 + (i % 7) * 40 * M_LAT, 72.9))
        eid += 1
        rows.append(("R1", "B3", (50 + 100 * i) * s, eid, 19.0 + (i % 5) * 70 * M_LAT, 72.9))
        eid += 1
    expect = bunching_fold(rows)
    assert len(expect) > 3
    got = bunching(_frame(spark, rows), pair_seconds=10).collect()
    assert sorted((r.route_id, r.bus_1, r.bus_2, r.distance_meters, r.duration_seconds,
                   r.event_id) for r in got) == expect


def test_random_routes_match_fold(spark):
    rnd = random.Random(7)
    rows, eid = [], 0
    for route in ("R1", "R2", "R3"):
        t = 0
        for _ in range(120):
            t += rnd.choice([0, 20, 45, 90, 150]) * 1_000_000
            bus = f"B{rnd.randint(1, 5)}"
            lat = 19.0 + rnd.randint(0, 6) * 60 * M_LAT
            rows.append((route, bus, t, eid, lat, 72.9))
            eid += 1
    expect = bunching_fold(rows)
    assert len(expect) > 10
    assert _batch(spark, rows, seconds=600) == expect


def test_ids_repeat_across_routes_and_nan_positions(spark):
    """Event ids need to be unique only within a route; NaN is no position."""
    rnd = random.Random(17)
    rows = []
    for route in ("R1", "R2", "R3"):
        t = 0
        for eid in range(120):
            t += rnd.choice([5, 40, 90, 140]) * 1_000_000
            lat = 19.0 + rnd.randint(0, 5) * 70 * M_LAT
            rows.append((route, f"B{rnd.randint(1, 4)}", t, eid,
                         float("nan") if rnd.random() < 0.05 else lat, 72.9))
    expect = bunching_fold(rows)
    assert len(expect) > 10
    assert _batch(spark, rows) == expect
    assert _batch(spark, rows, seconds=500, pair_seconds=15) == expect


def test_silent_bus_costs_no_all_pairs_join(spark):
    """Candidate pairs grow with the pairs that can pass, not with the square
    of the rows, when one bus stays silent."""
    from citystream.operators.bunching import near_segments, positioned
    def rows(n):
        out = [("R1", "B0", 0, 0, 19.0, 72.9)]
        for i in range(1, n):
            out.append(("R1", f"B{i % 6 + 1}", 20_000_000 * i, i,
                        19.0 + (i % 40) * 60 * M_LAT, 72.9))
        return out
    made = []
    for n in (400, 1600):
        g = positioned(_frame(spark, rows(n))).selectExpr(
            "route_id", "bus_id", "lat", "lon", "event_time as t", "event_id as e")
        seg = near_segments(g, pair_seconds=40)
        plan = seg._jdf.queryExecution()
        seg.collect()
        found = 0
        todo = [plan.executedPlan()]
        while todo:
            node = todo.pop()
            name = node.nodeName()
            if name == "AdaptiveSparkPlan":
                todo.append(node.executedPlan())
                continue
            if name.endswith("QueryStage"):
                todo.append(node.plan())
                continue
            if "Join" in name:
                rows_out = node.metrics().get("numOutputRows")
                found += int(rows_out.get().value()) if rows_out.isDefined() else 0
            kids = node.children()
            todo += [kids.apply(k) for k in range(kids.size())]
        made.append(found)
    assert 0 < made[1] <= 12 * made[0]


def test_silent_bus_spreads_no_short_interval(spark):
    """Short intervals go once into a silent bus's buckets, not once for each
    neighbour cell, and a copy goes only to cells that can hold a near position."""
    from citystream.operators.bunching import near_segments, positioned
    n = 600
    rows = [("R1", "B0", 0, 0, 19.0, 72.9)]
    rows += [("R1", f"B{i % 6 + 1}", 20_000_000 * i, i, 19.0 + (i % 40) * 60 * M_LAT, 72.9)
             for i in range(1, n)]
    g = positioned(_frame(spark, rows)).selectExpr(
        "route_id", "bus_id", "lat", "lon", "event_time as t", "event_id as e")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seg = near_segments(g, pair_seconds=240)
        plan = seg._jdf.queryExecution()
        seg.collect()
        moved, todo = 0, [plan.executedPlan()]
        while todo:
            node = todo.pop()
            name = node.nodeName()
            if name == "AdaptiveSparkPlan":
                todo.append(node.executedPlan())
                continue
            if name.endswith("QueryStage"):
                todo.append(node.plan())
                continue
            if name == "Exchange":
                moved += int(node.metrics().get("shuffleRecordsWritten").get().value())
            kids = node.children()
            todo += [kids.apply(k) for k in range(kids.size())]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert 0 < moved < 16 * n


def test_cells_in_reach_keep_every_near_point(spark):
    from pyspark.sql import functions as F

    from citystream.functions.geo import (cell_in_reach, haversine_m, neighbour_cells,
                                          sphere_cells, unit_vector)
    rnd = random.Random(5)
    pairs = []
    for i in range(3000):
        la, lo = rnd.uniform(-90, 90), rnd.uniform(-180, 180)
        if i % 10 == 0:
            la, lo = rnd.choice([0.0, 90.0, -90.0, 45.0]), rnd.choice([0.0, 90.0, 180.0, -45.0])
        d = rnd.choice([0, 1, 199.99]) * M_LAT
        turn = rnd.uniform(0, 6.3)
        pairs.append((i, la, lo, la + d * math.sin(turn), lo + d * math.cos(turn)))
    df = spark.createDataFrame(pairs, "i int, la double, lo double, lb double, lc double")
    a = sphere_cells(F.col("la"), F.col("lo"), 200.0)
    b = F.struct(*[c.alias(n) for c, n in zip(sphere_cells(F.col("lb"), F.col("lc"), 200.0),
                                              ("cx", "cy", "cz"))])
    cells = (df.where(haversine_m(F.col("la"), F.col("lo"), F.col("lb"), F.col("lc")) <= 200.0)
             .withColumn("n", F.explode(neighbour_cells(*a)))
             .where(cell_in_reach([F.col(f"n.{c}") for c in ("cx", "cy", "cz")],
                                  unit_vector(F.col("la"), F.col("lo")), 200.0)))
    per = cells.groupBy("i").agg(F.sum((F.struct("n.cx", "n.cy", "n.cz") == b).cast("int")).alias("hit"),
                                 F.count("*").alias("kept")).collect()
    assert len(per) > 2500 and all(r.hit == 1 for r in per)
    assert sum(r.kept for r in per) < 16 * len(per)


def test_stream_form_matches_fold(spark, tmp_path):
    from citystream.functions.time import ntz_to_utc
    from citystream.streaming.stateful import bunching_stream
    rnd = random.Random(3)
    rows = []
    t = 0
    for eid in range(150):
        t += rnd.choice([10, 60, 120]) * 1_000_000
        rows.append(("R1", f"B{rnd.randint(1, 4)}", t, eid,
                     19.0 + rnd.randint(0, 4) * 80 * M_LAT, 72.9))
    df = _frame(spark, rows)
    df.write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = (bunching_stream(s.withColumn("event_time", ntz_to_utc("event_time")))
         .writeStream.format("memory").queryName("bb_test").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.route_id, r.bus_1, r.bus_2, r.distance_meters, r.duration_seconds,
                  r.event_id) for r in spark.table("bb_test").collect())
    assert got == bunching_fold(rows)


def test_random_ties_and_radius_edges_distributed(spark):
    for seed in (11, 23, 42):
        rnd = random.Random(seed)
        rows = []
        for eid in range(160):
            route = rnd.choice(["R1", "R2"])
            t = rnd.choice(range(0, 3600, 30)) * 1_000_000         # many equal times
            metres = rnd.choice([0, 150, 199.9, 200.1, 260, 390, 600])
            lat = None if rnd.random() < 0.03 else 19.0 + metres * M_LAT
            rows.append((route, f"B{rnd.randint(1, 6)}", t, eid, lat, 72.9))
        expect = bunching_fold(rows)
        got = bunching(_frame(spark, rows), seconds=400,
                       pair_seconds=20).collect()
        assert sorted((r.route_id, r.bus_1, r.bus_2, r.distance_meters, r.duration_seconds,
                       r.event_id) for r in got) == expect, seed


def test_transform_with_state_form(spark, tmp_path):
    from citystream.functions.time import ntz_to_utc
    from citystream.streaming.stateful import bunching_stream_tws
    rnd = random.Random(5)
    rows, t = [], 0
    for eid in range(120):
        t += rnd.choice([10, 60, 120]) * 1_000_000
        rows.append((rnd.choice(["R1", "R2"]), f"B{rnd.randint(1, 4)}", t, eid,
                     19.0 + rnd.randint(0, 4) * 80 * M_LAT, 72.9))
    df = _frame(spark, rows)
    df.write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = (bunching_stream_tws(s.withColumn("event_time", ntz_to_utc("event_time")),
                             ttl_ms=86_400_000)
         .writeStream.format("memory").queryName("bb_tws").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(processingTime="1 second").start())
    # TTL needs processing time; such a query keeps running clean-up batches
    # until stopped: stop once the batch holding the input has committed.
    from tests.folds import wait_for_input
    wait_for_input(q)
    got = sorted((r.route_id, r.bus_1, r.bus_2, r.distance_meters, r.duration_seconds,
                  r.event_id) for r in spark.table("bb_tws").collect())
    assert got == bunching_fold(rows)

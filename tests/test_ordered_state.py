"""Event-order detectors with state by entity: any cut of the input gives the
batch alerts; silent buses and released rows leave the state."""
import datetime as dt
import random

import pandas as pd
import pytest

from citystream.functions.time import ntz_to_utc
from citystream.operators.bunching import bunching
from citystream.operators.gridlock import gridlock
from citystream.streaming.ordered import bunching_ordered, gridlock_ordered
from citystream.streaming.stateful import RouteFold
from tests.folds import bunching_fold

T0 = dt.datetime(2024, 1, 1)
GPS = "bus_id string, route_id string, lat double, lon double, event_time timestamp_ntz, event_id long"


def _files(spark, folder, schema, parts):
    """One file a part, in order of age."""
    import os
    for i, rows in enumerate(parts):
        path = f"{folder}/f{i:03d}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
        for f in os.listdir(path):
            os.utime(os.path.join(path, f), (1_600_000_000 + i, 1_600_000_000 + i))
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", True).parquet(folder)
            .withColumn("event_time", ntz_to_utc("event_time")))


def _run(alerts, name, checkpoint):
    q = (alerts.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def _gps_rows(n, buses, seed, step=40):
    rnd = random.Random(seed)
    return [(f"B{rnd.randrange(buses)}", "R1", 19.0 + rnd.randrange(4) * 0.0012, 72.9,
             T0 + dt.timedelta(seconds=step * i), i) for i in range(n)]


def _state(spark, checkpoint, name):
    return (spark.read.format("statestore").option("stateVarName", name).load(checkpoint))


def test_gridlock_whatever_the_files(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(f"J{rnd.randint(1, 3)}", "Z", rnd.choice([10.0, 200.0, 300.0, 400.0, None]),
             T0 + dt.timedelta(seconds=30 * i), i) for i in range(200)]
    schema = ("junction_id string, zone string, avg_wait_sec double, event_time timestamp_ntz, "
              "event_id long")
    want = sorted((r.junction_id, r.event_id)
                  for r in gridlock(spark.createDataFrame(rows, schema)).collect())
    marker = [("J1", "Z", 1.0, T0 + dt.timedelta(hours=9), 999)]
    untimed = [("J1", "Z", 999.0, None, 900)]
    assert len(want) > 5
    for name, files in (("one", 1), ("many", 6)):
        per = -(-200 // files)
        parts = [[r for r in rows if min(files - 1, r[4] // per + (r[4] % 4 == 0)) == f]
                 for f in range(files)]
        for p in parts:
            rnd.shuffle(p)
        stream = _files(spark, str(tmp_path / name), schema, [*parts, untimed + marker])
        ck = str(tmp_path / f"ck_{name}")
        _run(gridlock_ordered(stream, delay="40 minutes"), f"gl_{name}", ck)
        got = sorted((r.junction_id, r.event_id) for r in spark.table(f"gl_{name}").collect())
        assert got == want, name
        # Only the marker still waits.
        assert _state(spark, ck, "slots").count() == 1


def test_bunching_whatever_the_files(spark, tmp_path):
    rows = _gps_rows(150, 5, 1)
    df = spark.createDataFrame(rows, GPS)
    want = sorted((r.bus_1, r.bus_2, r.event_id, r.duration_seconds, r.distance_meters)
                  for r in bunching(df).collect())
    assert len(want) > 20
    late = sorted(rows, key=lambda r: r[5] + (7 if r[5] % 3 == 0 else 0))
    marker = [("B0", "R1", 19.0, 72.9, T0 + dt.timedelta(hours=9), 999)]
    stream = _files(spark, str(tmp_path / "in"), GPS,
                    [late[i:i + 40] for i in range(0, 150, 40)] + [marker])
    _run(bunching_ordered(stream, delay="10 minutes"), "bu_many", str(tmp_path / "ck"))
    got = sorted((r.bus_1, r.bus_2, r.event_id, r.duration_seconds, r.distance_meters)
                 for r in spark.table("bu_many").collect())
    assert got == want


def test_a_silent_bus_goes_by_its_own_timer(spark, tmp_path):
    """Its route gets no further row: only the other route moves the watermark."""
    rows = [("B1", "R1", 19.0, 72.9, T0, 1), ("B2", "R1", 19.0, 72.9, T0 + dt.timedelta(seconds=9), 2)]
    other = [(f"C{i % 2}", "R2", 19.0, 72.9, T0 + dt.timedelta(minutes=i), 100 + i) for i in range(0, 90, 10)]
    parts = [rows, *[[r] for r in other[1:4]], other[4:]]
    stream = _files(spark, str(tmp_path / "in"), GPS, parts)
    ck = str(tmp_path / "ck")
    q = _run(bunching_ordered(stream, delay="1 minute", silent_s=1800), "bu_silent", ck)
    left = {r.key.route_id for r in _state(spark, ck, "buses").select("key").collect()}
    assert left == {"R2"}
    assert _state(spark, ck, "pairs").where("key.route_id = 'R1'").count() == 0
    assert q.exception() is None


def test_state_does_not_grow_with_history(spark, tmp_path):
    held = []
    for n in (120, 360):
        rows = _gps_rows(n, 4, 3)
        stream = _files(spark, str(tmp_path / f"in{n}"), GPS,
                        [rows[i:i + 60] for i in range(0, n, 60)])
        q = _run(bunching_ordered(stream, delay="5 minutes", silent_s=3600), f"grow{n}",
                 str(tmp_path / f"ck{n}"))
        held.append([p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress
                     if p["stateOperators"]])
    assert max(held[1]) <= 1.5 * max(held[0])


@pytest.mark.parametrize("seed", range(6))
def test_fold_against_the_rule(seed):
    rows = _gps_rows(300, 6, seed, step=25)
    pdf = pd.DataFrame([(b, la, lo, e, int((t - T0).total_seconds() * 1e6))
                        for b, _, la, lo, t, e in rows],
                       columns=["bus_id", "lat", "lon", "event_id", "ts_us"])
    whole = RouteFold("R1", {}, {}, 200.0, 300_000_000).run(pdf)
    want = bunching_fold([("R1", b, us, e, la, lo) for b, la, lo, e, us in
                          pdf.itertuples(index=False)])
    assert sorted((*a[:3], round(a[3], 2), a[4], a[5]) for a in whole) == want and want
    # The same in pieces, state handed on.
    buses, timers, got = {}, {}, []
    for lo in range(0, 300, 37):
        fold = RouteFold("R1", buses, timers, 200.0, 300_000_000)
        got += fold.run(pdf[lo:lo + 37])
        buses, timers = fold.buses(), fold.timers()
    assert got == whole


def test_fold_forgets_silent_buses():
    def rows(*at):
        return pd.DataFrame([(b, 19.0, 72.9, i, int(s * 1e6)) for i, (b, s) in enumerate(at)],
                            columns=["bus_id", "lat", "lon", "event_id", "ts_us"])
    fold = RouteFold("R", {}, {}, 200.0, 300_000_000, 600_000_000)
    out = fold.run(rows(("a", 0), ("b", 10), ("b", 320), ("b", 600.5), ("b", 700), ("a", 800),
                        ("b", 1000), ("b", 1110)))
    # a and b alert at 320; a is silent from 600 on, comes back at 800 as the
    # later bus, and its timer starts anew.
    assert [(a[1], a[2], a[6]) for a in out] == [("a", "b", 320_000_000), ("b", "a", 1_110_000_000)]
    assert set(fold.buses()) == {"a", "b"}
    fold.forget_before(10 ** 10)
    assert not fold.buses() and not fold.timers()

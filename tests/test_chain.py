"""The walk by slices equals a step-by-step walk of the successor chain."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from citystream.plans import chain

T0 = dt.datetime(2024, 1, 1)
TICK = "struct<t:timestamp_ntz,e:long>"


def _naive(times, ids, s, f, hold):
    """Steps (from, to) of ticks 0..n-1 in (time, id) order; f exclusive or None."""
    out, cur = [], s
    while True:
        nxt = next((k for k in range(cur + 1, len(times)) if times[k] >= times[cur] + hold), None)
        if nxt is None or (f is not None and nxt >= f):
            return out
        out.append((ids[cur], ids[nxt]))
        cur = nxt


def _case(spark, rnd, routes, islands, hold):
    rows, starts, want = [], [], []
    for route, times in routes.items():
        ids = list(range(len(times)))
        rnd.shuffle(ids)
        order = sorted(range(len(times)), key=lambda i: (times[i], ids[i]))
        times, ids = [times[i] for i in order], [ids[i] for i in order]
        tick = [(T0 + dt.timedelta(seconds=x), i) for x, i in zip(times, ids)]
        rows += [(route, *x) for x in tick]
        for sid in range(islands):
            s = rnd.randrange(len(times))
            f = rnd.choice([None, min(len(times) - 1, s + rnd.randrange(0, len(times)))])
            starts.append((route, sid, tick[s], None if f is None else tick[f]))
            want += [(route, sid, *x) for x in _naive(times, ids, s, f, hold)]
    ticks = spark.createDataFrame(rows, "route_id string, t timestamp_ntz, e long")
    isl = spark.createDataFrame(starts, f"route_id string, sid long, s {TICK}, f {TICK}")
    return ticks, isl, sorted(want)


@pytest.mark.parametrize("seconds,share", [(100_000, 100_000), (300, 3), (1000, 7)])
def test_steps_match_naive(spark, monkeypatch, seconds, share):
    """One slice; slices of one hold time; shares of a few islands."""
    monkeypatch.setattr(chain, "SHARE", share)
    monkeypatch.setattr(chain, "chain_seconds", lambda s, h: max(s, h))
    rnd = random.Random(seconds)
    routes = {"dense": sorted(rnd.sample(range(0, 40_000), 400)),
              # Ties, gaps over several slices, and slices without a tick.
              "ties": sorted(rnd.randrange(0, 60) * 50 for _ in range(150)),
              "sparse": sorted(rnd.sample(range(0, 400_000), 40)),
              "edges": [0, 299, 300, 300, 599, 600, 900, 1199, 1200, 1499, 5000, 5300],
              "one": [77]}
    ticks, isl, want = _case(spark, rnd, routes, 25, 300)
    got = chain.steps(ticks, isl, ["route_id", "sid"], 300, seconds).select(
        "route_id", "sid", F.col("prev.e").alias("p"), F.col("at.e").alias("a")).collect()
    assert sorted(tuple(r) for r in got) == want
    assert max(sum(w[0] == "dense" and w[1] == sid for w in want) for sid in range(25)) > 20


def test_no_islands_and_no_ticks(spark):
    ticks = spark.createDataFrame([("R", T0, 1)], "route_id string, t timestamp_ntz, e long")
    isl = spark.createDataFrame([], f"route_id string, sid long, s {TICK}, f {TICK}")
    assert chain.steps(ticks, isl, ["route_id", "sid"], 300, 3600).count() == 0
    assert chain.steps(ticks.where("false"), isl, ["route_id", "sid"], 300, 3600).count() == 0


def test_width_of_slices():
    assert chain.chain_seconds(3600, 300) == 9600 and chain.chain_seconds(604_800, 300) == 604_800
    # Dense keys: a few of the rows' own slices, one hold time at least.
    assert chain.chain_seconds(50, 300) == 400 and chain.chain_seconds(1, 300) == 300

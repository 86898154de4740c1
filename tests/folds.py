"""Test oracles of the two stateful rules, written from their definitions.

Gridlock: in a junction's sequence of cycles, each maximal run of waits above
the limit raises an alert at its 3rd, 6th, 9th ... cycle.  Bunching: for a pair
of buses, the route's ticks at which both are known and near form stretches;
from a stretch's first tick on, the next alert is the first tick at least the
hold time after the last mark.
"""
from bisect import bisect_left
from collections import defaultdict
from itertools import combinations, groupby
from math import asin, cos, dist, radians, sin

EARTH_M = 6371000.0


def gridlock_fold(rows, limit=180.0):
    """rows: (junction, t_us, event_id, wait or None) -> [(junction, event_id, waits)]."""
    cycles = defaultdict(list)
    for junction, t, eid, wait in rows:
        cycles[junction].append((t, eid, wait or 0.0))
    found = []
    for junction, seq in cycles.items():
        for above, run in groupby(sorted(seq), key=lambda c: c[2] > limit):
            run = list(run) if above else []
            found += [(junction, run[k][1], tuple(c[2] for c in run[k - 2:k + 1]))
                      for k in range(2, len(run), 3)]
    return sorted(found)


def metres(p, q):
    """Great-circle distance from the chord between unit vectors."""
    u, v = ((cos(radians(la)) * cos(radians(lo)), cos(radians(la)) * sin(radians(lo)),
             sin(radians(la))) for la, lo in (p, q))
    return 2 * EARTH_M * asin(min(1.0, dist(u, v) / 2))


def bunching_fold(rows, radius=200.0, hold_us=300_000_000):
    """rows: (route, bus, t_us, event_id, lat, lon) -> alerts
    [(route, bus_1, bus_2, dist2dp, duration_s, event_id)]."""
    routes = defaultdict(list)
    for route, bus, t, eid, la, lo in rows:
        if la is not None and lo is not None and la == la and lo == lo:
            routes[route].append((t, eid, bus, (la, lo)))
    found = []
    for route, ticks in routes.items():
        ticks.sort(key=lambda x: x[:2])
        times = [x[0] for x in ticks]
        seen = {}
        for n, (_, _, bus, _) in enumerate(ticks):
            seen.setdefault(bus, n)
        for a, b in combinations(sorted(seen, key=seen.get), 2):
            where, apart = {}, []
            for _, _, bus, at in ticks:
                where[bus] = at
                both = a in where and b in where
                apart.append(metres(where[a], where[b]) if both else float("inf"))
            for near, stretch in groupby(range(len(ticks)), key=lambda n: apart[n] <= radius):
                stretch = list(stretch) if near else [0]
                mark, end = stretch[0], stretch[-1]
                while near:
                    n = bisect_left(times, times[mark] + hold_us, mark + 1)
                    if n > end:
                        break
                    found.append((route, a, b, round(apart[n], 2),
                                  (times[n] - times[mark]) // 1_000_000, ticks[n][1]))
                    mark = n
    return sorted(found)


def wait_for_input(q, timeout_s: float = 90.0) -> None:
    """Stop a processing-time query once a batch with input has committed."""
    import time
    start = time.time()
    while time.time() - start < timeout_s:
        if any(p["numInputRows"] > 0 for p in q.recentProgress):
            break
        time.sleep(0.5)
    q.stop()

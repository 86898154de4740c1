"""Greedy chains over the ticks of a key, by composing slices of time.

The alerts of an island (start tick s, exclusive end f) are succ(s),
succ(succ(s)), ... while they stay before f, where succ(x) is the key's first
tick at least the hold time after x.  The walk is sequential, but a slice of
time acts on it as a map: a chain that enters a slice at some tick leaves it
behind some last tick x, and goes on at the first tick from x + hold on.  Slices
are at least one hold time wide, so that probe time lies in the next slice or
before it.

1. ticks are packed by (key, slice); a slice knows, for each tick at which a
   chain can enter it (those of its first hold time and the next) or starts in
   it, the last tick of that chain inside.  Chains run together, so these are few;
2. their probe times go to the key's next slice, which maps each to the tick
   entered and the last one;
3. islands that go on beyond their slice walk the maps of their key, one look-up
   a slice, all islands of a slice at once; islands of a hot key are dealt to
   several tasks, each with the key's maps;
4. each slice expands the chains that start in it or enter it, up to f.

That is a fixed number of shuffles, whatever the length of the chains.  No task
holds more than a slice of a key's ticks, or a key's maps and a share of its
islands.  Ticks are (time, id): ids need to be unique only within a key and
time.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citystream.functions.time import epoch_micros, micros_to_ntz
from citystream.session import cut as _cut

# Workers need only NumPy and Arrow (see ``streaming.stateful``).
_cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Probe of a chain that passes a slice without a tick: it enters the next one at
#: its first tick.
FIRST = -(2 ** 62)
OPEN = 2 ** 62
#: Islands of a key that walk in one task, and that a slice expands at once.
SHARE = 100_000


def chain_seconds(seconds: int, hold_s: int) -> int:
    """Width of a chain's slices: many hold times, so that maps are small next to
    the ticks, but no more than a few of the rows' own slices."""
    return max(int(hold_s), min(max(int(seconds), 32 * int(hold_s)), 8 * int(seconds)), 1)


class _Ticks:
    """Sorted ticks of one slice with each one's successor inside (n: none)."""

    def __init__(self, t: np.ndarray, e: np.ndarray, hold_us: int):
        self.t, self.e, self.n = t, e, len(t)
        self.next = np.searchsorted(t, t + hold_us, "left")

    def last(self) -> np.ndarray:
        """Last tick inside of the chain from each tick, by doubling."""
        to = np.where(self.next < self.n, self.next, np.arange(self.n))
        while True:
            far = to[to]
            if (far == to).all():
                return to
            to = far

    def expand(self, iid, at, prev_t, prev_e, f_t, f_e, entered: bool):
        """Alerts of chains at ticks ``at``; with ``entered`` these ticks are
        alerts themselves, behind (prev_t, prev_e)."""
        out = []
        if entered:
            out.append((iid, prev_t, prev_e, self.t[at], self.e[at]))
        while len(at):
            to = self.next[at]
            go = to < self.n
            to, at, iid, f_t, f_e = to[go], at[go], iid[go], f_t[go], f_e[go]
            go = (self.t[to] < f_t) | ((self.t[to] == f_t) & (self.e[to] < f_e))
            to, at, iid, f_t, f_e = to[go], at[go], iid[go], f_t[go], f_e[go]
            if len(to):
                out.append((iid, self.t[at], self.e[at], self.t[to], self.e[to]))
            at = to
        return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 5


def _longs(raw) -> np.ndarray:
    return np.frombuffer(raw, "<i8")


def _raw(x: np.ndarray) -> bytes:
    return x.astype("<i8").tobytes()


_SLICE = ("key string, slice long, ts binary, es binary, iids binary, starts binary, "
          "fts binary, fes binary, exits binary")
_STEP = "iid long, prev_t long, prev_e long, at_t long, at_e long"


def _pack(hold_us: int, width_us: int):
    def run(rows: pa.Table) -> pa.Table:
        """Ticks (iid null) and island starts of one (key, slice) -> its row."""
        is_tick = rows["iid"].is_null()
        ticks, own = rows.filter(is_tick), rows.filter(pc.invert(is_tick))
        t, e = ticks["t"].to_numpy(), ticks["e"].to_numpy()
        order = np.lexsort((e, t))
        k = _Ticks(t[order], e[order], hold_us)
        st, se = own["t"].to_numpy(), own["e"].to_numpy()
        lo, hi = np.searchsorted(k.t, st, "left"), np.searchsorted(k.t, st, "right")
        start = lo.copy()
        for i in np.flatnonzero(hi - lo > 1):
            start[i] += np.searchsorted(k.e[lo[i]:hi[i]], se[i])
        slice_ = rows["slice"][0].as_py()
        # Ticks that a probe before start + hold can find: one behind that too.
        near = np.searchsorted(k.t, slice_ * width_us + hold_us, "left")
        entry = np.arange(min(k.n, near + 1))
        exits = np.unique(k.last()[np.concatenate([entry, start])])
        packed = [pa.array([_raw(x)], pa.binary()) for x in
                  (k.t, k.e, own["iid"].to_numpy(), start, own["f_t"].to_numpy(),
                   own["f_e"].to_numpy(), exits)]
        return pa.table([rows["key"].slice(0, 1), pa.array([slice_]), *packed],
                        names=[c.split()[0] for c in _SLICE.split(", ")])
    return run


def _batch(cols: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names)


def _inside(hold_us: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Slices -> alerts of the islands that start in them, up to their end."""
        for b in batches:
            for r in b.to_pylist():
                k = _Ticks(_longs(r["ts"]), _longs(r["es"]), hold_us)
                iid, start, f_t, f_e = (_longs(r[c]) for c in ("iids", "starts", "fts", "fes"))
                yield _batch(k.expand(iid, start, None, None, f_t, f_e, False),
                             ["iid", "prev_t", "prev_e", "at_t", "at_e"])
    return run


def _leaving(hold_us: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Slices -> islands that may go on behind them, at their last tick."""
        for b in batches:
            for r in b.to_pylist():
                k = _Ticks(_longs(r["ts"]), _longs(r["es"]), hold_us)
                iid, start, f_t, f_e = (_longs(r[c]) for c in ("iids", "starts", "fts", "fes"))
                x = k.last()[start]
                on = f_t >= k.t[x] + hold_us
                n = int(on.sum())
                yield _batch([pa.array([r["key"]] * n, pa.string()), iid[on],
                              np.full(n, r["slice"]), k.t[x[on]], k.e[x[on]], f_t[on], f_e[on]],
                             ["key", "iid", "slice", "x_t", "x_e", "f_t", "f_e"])
    return run


def _exits(hold_us: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                p = np.unique(_longs(r["ts"])[_longs(r["exits"])] + hold_us)
                yield _batch([pa.array([r["key"]] * len(p), pa.string()),
                              np.full(len(p), r["slice"]), p], ["key", "slice", "p"])
    return run


_MAP = "key string, slice long, p long, in_t long, in_e long, x_t long, x_e long"


def _maps(hold_us: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Slices with the probes that reach them -> (probe, tick entered, last
        tick); a probe behind all ticks has null ticks."""
        for b in batches:
            for r in b.to_pylist():
                k = _Ticks(_longs(r["ts"]), _longs(r["es"]), hold_us)
                p = np.array([FIRST, *(r["probes"] or [])], np.int64)
                at = np.searchsorted(k.t, p, "left")
                none = at == k.n
                own = np.where(none, 0, at)
                x = k.last()[own]
                yield _batch([pa.array([r["key"]] * len(p), pa.string()), np.full(len(p), r["slice"]), p,
                              *(pa.array(c, mask=none) for c in (k.t[own], k.e[own], k.t[x], k.e[x]))],
                             [c.split()[0] for c in _MAP.split(", ")])
    return run


_VISIT = ("key string, slice long, iid long, prev_t long, prev_e long, in_t long, in_e long, "
          "f_t long, f_e long")


def _walk(hold_us: int):
    names = [c.split()[0] for c in _VISIT.split(", ")]

    def run(key, maps: pa.Table, islands: pa.Table) -> pa.Table:
        """The maps of a key and a share of its islands -> the slices that the
        islands' chains enter behind their own, with the tick entered."""
        out: list[list[np.ndarray]] = []
        islands, maps = islands.sort_by("slice"), maps.sort_by([("slice", "ascending"), ("p", "ascending")])
        begin, of = islands["slice"].to_numpy(), maps["slice"].to_numpy()
        # Of each island: last tick so far, its next probe.
        own = {c: islands[c].to_numpy().copy() for c in ("iid", "x_t", "x_e", "f_t", "f_e")}
        probe, alive = own["x_t"] + hold_us, np.zeros(len(begin), bool)
        ps, none = maps["p"].to_numpy(), maps["in_t"].is_null().to_numpy()
        tick = {c: maps[c].fill_null(0).to_numpy() for c in ("in_t", "in_e", "x_t", "x_e")}
        cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)] if len(of) else []
        done = 0
        for lo, hi in zip(cuts, cuts[1:]):
            i = np.flatnonzero(alive)
            row = lo + np.searchsorted(ps[lo:hi], probe[i])
            probe[i[none[row]]] = FIRST
            i, row = i[~none[row]], row[~none[row]]
            new = {c: v[row] for c, v in tick.items()}
            go = (new["in_t"] < own["f_t"][i]) | ((new["in_t"] == own["f_t"][i])
                                                  & (new["in_e"] < own["f_e"][i]))
            alive[i[~go]] = False
            i, new = i[go], {c: v[go] for c, v in new.items()}
            out.append([np.full(len(i), of[lo]), own["iid"][i], own["x_t"][i], own["x_e"][i],
                        new["in_t"], new["in_e"], own["f_t"][i], own["f_e"][i]])
            own["x_t"][i], own["x_e"][i] = new["x_t"], new["x_e"]
            probe[i] = new["x_t"] + hold_us
            # A chain whose next tick would lie behind its end is over.
            alive[i[probe[i] > own["f_t"][i]]] = False
            upto = int(np.searchsorted(begin, of[lo], "right"))
            alive[done:upto] = True
            done = upto
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 8
        return pa.table([pa.array([key[0].as_py()] * len(cols[0]), pa.string()),
                         *map(pa.array, cols)], names=names)
    return run


def _entered(hold_us: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Slices with the chains that enter them -> their alerts inside."""
        for b in batches:
            for r in b.to_pylist():
                k = _Ticks(_longs(r["ts"]), _longs(r["es"]), hold_us)
                v = {c: np.array([x[c] for x in r["visits"]], np.int64)
                     for c in ("iid", "prev_t", "prev_e", "in_t", "in_e", "f_t", "f_e")}
                # The tick entered is the first one of its time.
                at = np.searchsorted(k.t, v["in_t"], "left")
                yield _batch(k.expand(v["iid"], at, v["prev_t"], v["prev_e"], v["f_t"], v["f_e"], True),
                             ["iid", "prev_t", "prev_e", "at_t", "at_e"])
    return run


def steps(ticks: DataFrame, islands: DataFrame, id_cols: list[str], hold_s: int, seconds: int,
          key: str = "route_id") -> DataFrame:
    """Alert steps of each island: (id_cols..., prev struct<t,e>, at struct<t,e>).

    ``ticks``: (key, t, e); ``islands``: ``id_cols`` (``key`` among them), ``s``
    (struct<t,e>, a tick of the key) and ``f`` (struct<t,e> exclusive end, null =
    open).  A step is taken while its target is strictly before ``f``.
    """
    hold_us, width_us = int(hold_s) * 1_000_000, chain_seconds(seconds, hold_s) * 1_000_000
    islands = _cut(islands.select(*dict.fromkeys([*id_cols, "s", "f"])).withColumn(
        "iid", F.monotonically_increasing_id()))
    slice_ = F.floor(F.col("t") / width_us).cast("long").alias("slice")
    rows = ticks.select(F.col(key).cast("string").alias("key"), epoch_micros("t").alias("t"), "e",
                        *[F.lit(None).cast("long").alias(c) for c in ("iid", "f_t", "f_e")])
    starts = islands.select(
        F.col(key).cast("string").alias("key"), epoch_micros(F.col("s.t")).alias("t"),
        F.col("s.e").alias("e"), "iid", F.coalesce(epoch_micros(F.col("f.t")), F.lit(OPEN)).alias("f_t"),
        F.coalesce(F.col("f.e"), F.lit(0).cast("long")).alias("f_e"))
    slices = _cut(rows.unionByName(starts).select("key", slice_, "t", "e", "iid", "f_t", "f_e")
                  .groupBy("key", "slice").applyInArrow(_pack(hold_us, width_us), _SLICE))
    # The key's next slice that has ticks: one row a slice.
    then = slices.select("key", "slice", F.lead("slice").over(
        Window.partitionBy("key").orderBy("slice")).alias("then"))
    probes = (slices.select("key", "slice", "ts", "exits")
              .mapInArrow(_exits(hold_us), "key string, slice long, p long")
              .join(then.where("then is not null"), ["key", "slice"])
              .groupBy("key", F.col("then").alias("slice")).agg(F.collect_set("p").alias("probes")))
    maps = (slices.select("key", "slice", "ts", "es").join(probes, ["key", "slice"], "left")
            .mapInArrow(_maps(hold_us), _MAP))
    inside = slices.select("ts", "es", "iids", "starts", "fts", "fes").mapInArrow(_inside(hold_us), _STEP)
    leaving = slices.select("key", "slice", "ts", "es", "iids", "starts", "fts", "fes").mapInArrow(
        _leaving(hold_us), "key string, iid long, slice long, x_t long, x_e long, f_t long, f_e long")
    # Islands that leave their slice, dealt to shares of a bounded size.
    share = F.pmod(F.xxhash64("iid"), F.col("shares")).alias("share")
    sizes = leaving.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / SHARE).alias("shares"))
    dealt = leaving.join(sizes, "key").select("*", share)
    of_key = maps.join(sizes, "key").select(
        *[c.split()[0] for c in _MAP.split(", ")],
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"))
    visits = (of_key.groupBy("key", "share").cogroup(dealt.groupBy("key", "share"))
              .applyInArrow(_walk(hold_us), _VISIT))
    visits = _cut(visits)
    part = F.pmod(F.col("iid"), F.col("parts")).alias("part")
    heavy = visits.groupBy("key", "slice").agg(F.ceil(F.count(F.lit(1)) / SHARE).alias("parts"))
    lists = (visits.join(heavy, ["key", "slice"]).select("*", part).groupBy("key", "slice", "part")
             .agg(F.collect_list(F.struct("iid", "prev_t", "prev_e", "in_t", "in_e", "f_t", "f_e"))
                  .alias("visits")))
    entered = (slices.select("key", "slice", "ts", "es").join(lists, ["key", "slice"])
               .select("ts", "es", "visits").mapInArrow(_entered(hold_us), _STEP))

    def tick(name: str):
        return F.struct(micros_to_ntz(F.col(f"{name}_t")).alias("t"), F.col(f"{name}_e").alias("e"))
    return (inside.unionByName(entered).join(islands.select("iid", *id_cols), "iid")
            .select(*id_cols, tick("prev").alias("prev"), tick("at").alias("at")))

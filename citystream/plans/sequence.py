"""Ordered per-key scans that stay balanced when one key is very hot.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task.  If
one junction or route carries a third of all rows, that task gets a third of
the data.  Each helper here partitions the window by ``(key, time slice)``
instead, so one task sees at most one slice of one key, and then repairs the
slice boundaries from a per-slice summary (one row per key and non-empty
slice: tiny next to the data).  The summary is scanned with an ordinary
window per key (its size is bounded by the number of slices, not by rows),
and joined back on ``(key, slice)``, a key the big side is already
partitioned by after the window's shuffle.

Rows are ordered by ``(t, id)``: event time, then a unique tie-break.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citystream.functions.time import epoch_micros, split_id

# Width of a time slice.  A slice of one key must fit a task comfortably:
# at the design rates (a few thousand events/s over all keys) an hour of even
# the hottest key is a few million small rows.
DEFAULT_SPLIT_SECONDS = 3600

SPLIT = "_slice"

# Rows of the busiest key per slice that a task should see.
TARGET_SLICE_ROWS = 1_000_000
MAX_SLICE_SECONDS = 7 * 86400


def slice_seconds(df: DataFrame, keys: Sequence[str], t: str,
                  target_rows: int = TARGET_SLICE_ROWS) -> int:
    """Slice width so the busiest key holds about ``target_rows`` per slice.

    One aggregate job (partial counts before the shuffle): the largest key
    count and the time span.  Assumes the busiest key's rows are spread over
    the span; bursts only make some slices larger, not unbounded.
    """
    r = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                               F.min(epoch_micros(t)).alias("lo"),
                               F.max(epoch_micros(t)).alias("hi"))
           .agg(F.max("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
           .first())
    if not r or not r["n"]:
        return DEFAULT_SPLIT_SECONDS
    span_s = max((r["hi"] - r["lo"]) / 1e6, 1.0)
    width = span_s * target_rows / r["n"]
    return int(min(max(width, 1), MAX_SLICE_SECONDS))


def with_slice(df: DataFrame, t: str, seconds: int) -> DataFrame:
    return df.withColumn(SPLIT, split_id(t, seconds))


def order_key(t: str, e: str) -> Column:
    """Struct (t, e): compares lexicographically, usable in min/max/max_by."""
    return F.struct(F.col(t).alias("t"), F.col(e).alias("e"))


def keyed_neighbor(df: DataFrame, keys: Sequence[str], t: str, e: str,
                   cols: Sequence[str], out: str, step: int = 1,
                   seconds: int = DEFAULT_SPLIT_SECONDS) -> DataFrame:
    """Add ``out``: struct of ``cols`` from the next (step=1) or previous
    (step=-1) row of the same key in (t, e) order; null when there is none.
    """
    keys = list(keys)
    payload = F.struct(*[F.col(c) for c in cols])
    d = with_slice(df, t, seconds)
    w = Window.partitionBy(*keys, SPLIT).orderBy(t, e)
    nb = F.lead(payload).over(w) if step > 0 else F.lag(payload).over(w)
    d = d.withColumn("_nb", nb)
    edge = (F.min_by(payload, order_key(t, e)) if step > 0
            else F.max_by(payload, order_key(t, e)))
    summ = with_slice(df, t, seconds).groupBy(*keys, SPLIT).agg(edge.alias("_edge"))
    ws = Window.partitionBy(*keys).orderBy(SPLIT)
    carry = F.lead("_edge").over(ws) if step > 0 else F.lag("_edge").over(ws)
    summ = summ.select(*keys, SPLIT, carry.alias("_carry"))
    return (d.join(summ, [*keys, SPLIT], "left")
             .withColumn(out, F.coalesce("_nb", "_carry"))
             .drop("_nb", "_carry", SPLIT))


def keyed_fill(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
               slice_col: Column, value: Column, out: str,
               descending: bool = False) -> DataFrame:
    """Add ``out``: the last non-null ``value`` at or before each row of the
    same key, scanning rows by the ``order`` values (ascending, or descending
    for a backward fill).  ``slice_col`` must be monotone in ``order``.
    """
    keys = list(keys)
    names = [f"_o{i}" for i in range(len(order))]
    base = (df.withColumn(SPLIT, slice_col).withColumn("_v", value)
              .select("*", *[o.alias(n) for o, n in zip(order, names)]))
    sort = [F.col(n).desc() if descending else F.col(n).asc() for n in names]
    w = (Window.partitionBy(*keys, SPLIT).orderBy(*sort)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = base.withColumn("_f", F.last("_v", ignorenulls=True).over(w))
    # Last non-null value of each slice in scan order; rows with a null value
    # are skipped by max_by/min_by (their ordering key is null).  Computed from
    # the rows before the window, so it aggregates map-side and shuffles only
    # one partial row per (key, slice) and task.
    rank = F.when(F.col("_v").isNotNull(), F.struct(*[F.col(n) for n in names]))
    pick = F.min_by("_v", rank) if descending else F.max_by("_v", rank)
    summ = base.groupBy(*keys, SPLIT).agg(pick.alias("_edge"))
    ws = (Window.partitionBy(*keys)
          .orderBy(F.col(SPLIT).desc() if descending else F.col(SPLIT).asc())
          .rowsBetween(Window.unboundedPreceding, -1))
    summ = summ.select(*keys, SPLIT, F.last("_edge", ignorenulls=True).over(ws).alias("_carry"))
    return (d.join(summ, [*keys, SPLIT], "left")
             .withColumn(out, F.coalesce("_f", "_carry"))
             .drop("_v", "_f", "_carry", SPLIT, *names))

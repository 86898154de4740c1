"""Junction gridlock: the wait exceeds a limit on 3 consecutive cycles.

Rule per junction, in event order: keep the last 3 waits; when all 3 are
strictly above the limit, raise an incident carrying them and clear the
history (so alerts never overlap).  A missing or null wait counts as 0.

Batch form (gaps and islands).  With ``pos`` = the row's position inside
its current run of waits above the limit, the rule fires exactly on rows
with ``pos`` a positive multiple of 3.  ``pos`` = row number - row number of
the last low wait at or before the row (0 when none).  Row numbers and "last
low" are computed per (junction, time slice) with window functions, and the
counts of earlier slices are carried in from a per-slice summary, so a hot
junction is spread over many tasks (see ``plans.sequence``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citystream.operators.incidents import GRIDLOCK_MESSAGE, HIGH, TRAFFIC_GRIDLOCK
from citystream.plans.sequence import SPLIT, order_key, slice_seconds, with_slice

# Wait limit (seconds, strict) and run length.
WAIT_LIMIT_SEC = 180.0
RUN_LENGTH = 3


def gridlock(signals: DataFrame, limit: float = WAIT_LIMIT_SEC, key: str = "junction_id",
             wait_col: str = "avg_wait_sec", t: str = "event_time", e: str = "event_id",
             seconds: int | None = None) -> DataFrame:
    """Gridlock incidents from a batch of signal cycles.

    Out: incident_type, severity, junction_id, zone, consecutive_wait_times
    (oldest first), message, event_id, event_time, details (struct).
    ``seconds`` is the time-slice width; by default it is sized from the data
    so the busiest junction holds about a million rows per slice.
    """
    n = RUN_LENGTH
    signals = signals.where(F.col(t).isNotNull())  # no event time: no place in the order
    seconds = seconds or slice_seconds(signals, [key], t)
    d = with_slice(signals.withColumn("_w", F.coalesce(F.col(wait_col).cast("double"),
                                                       F.lit(0.0))), t, seconds)
    d = d.withColumn("_high", F.col("_w") > F.lit(float(limit)))
    w = Window.partitionBy(key, SPLIT).orderBy(t, e)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = (d.withColumn("_r", F.row_number().over(w))
          .withColumn("_low", F.max(F.when(~F.col("_high"), F.col("_r"))).over(upto))
          .withColumn("_lag1", F.lag("_w", 1).over(w))
          .withColumn("_lag2", F.lag("_w", 2).over(w)))

    # Per slice: size, last low row, last two waits.
    last = F.max_by(F.struct(F.col("_w").alias("w1"), F.col("_lag1").alias("w2")),
                    order_key(t, e))
    summ = d.groupBy(key, SPLIT).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max(F.when(~F.col("_high"), F.col("_r"))).alias("_lastlow"),
        last.alias("_tail"))
    ws = Window.partitionBy(key).orderBy(SPLIT)
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    summ = (summ
            .withColumn("_c", F.coalesce(F.sum("_n").over(before), F.lit(0)))
            .withColumn("_lowabs", F.col("_c") + F.col("_lastlow"))
            .select(key, SPLIT, "_c",
                    F.max("_lowabs").over(before).alias("_lowprev"),
                    F.lag("_tail.w1", 1).over(ws).alias("_p1"),
                    F.when(F.lag("_n", 1).over(ws) >= 2, F.lag("_tail.w2", 1).over(ws))
                     .otherwise(F.lag("_tail.w1", 2).over(ws)).alias("_p2")))

    j = d.join(summ, [key, SPLIT], "left")
    pos = (F.col("_c") + F.col("_r")
           - F.coalesce(F.col("_c") + F.col("_low"), F.col("_lowprev"), F.lit(0)))
    hit = j.where(F.col("_high") & (pos % n == 0))
    r = F.col("_r")
    w2 = F.when(r >= 2, F.col("_lag1")).otherwise(F.col("_p1"))
    w3 = (F.when(r >= 3, F.col("_lag2")).when(r == 2, F.col("_p1"))
           .otherwise(F.col("_p2")))
    waits = F.array(w3, w2, F.col("_w"))
    zone = F.col("zone") if "zone" in signals.columns else F.lit(None).cast("string")
    return hit.select(
        F.lit(TRAFFIC_GRIDLOCK).alias("incident_type"), F.lit(HIGH).alias("severity"),
        F.col(key).alias("junction_id"), zone.alias("zone"),
        waits.alias("consecutive_wait_times"), F.lit(GRIDLOCK_MESSAGE).alias("message"),
        F.col(e).alias("event_id"), F.col(t).alias("event_time"),
        F.struct(F.col(key).alias("junction_id"), zone.alias("zone"),
                 waits.alias("consecutive_wait_times"),
                 F.lit(GRIDLOCK_MESSAGE).alias("message")).alias("details"))

"""Event-time window aggregates (batch and streaming, same code).

On a stream, pass ``delay`` to set a watermark: state for a window is dropped
once the watermark passes its end, and append mode emits each window once,
when it closes.  The event-time column must then be TIMESTAMP (watermarks do
not accept TIMESTAMP_NTZ); batch input may use either type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from citystream.functions.time import epoch_micros


def _watermarked(df: DataFrame, time_col: str, delay: str | None) -> DataFrame:
    return df.withWatermark(time_col, delay) if delay else df


def ward_energy(df: DataFrame, window: str = "15 minutes", delay: str | None = None,
                time_col: str = "event_time") -> DataFrame:
    """Tumbling-window energy totals per ward.

    Out: window_start, window_end, ward_id, date, total_kwh_consumed,
    avg_power_factor, peak_voltage.  Partial aggregation runs before the
    shuffle on (window, ward_id), so shuffle volume is one row per window and
    ward per input partition, whatever the input size.
    """
    agg = (_watermarked(df, time_col, delay)
           .groupBy(F.window(time_col, window).alias("w"), "ward_id")
           .agg(F.sum("kwh_reading").alias("total_kwh_consumed"),
                F.avg("power_factor").alias("avg_power_factor"),
                F.max("voltage").alias("peak_voltage")))
    return agg.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "ward_id", F.date_format("w.start", "yyyy-MM-dd").alias("date"),
        "total_kwh_consumed", "avg_power_factor", "peak_voltage")


def _seconds(interval: str) -> int:
    n, unit = interval.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(n) * mult


def rolling_aqi(df: DataFrame, window: str = "10 minutes", slide: str = "1 minute",
                delay: str | None = None, time_col: str = "event_time",
                key: str = "zone") -> DataFrame:
    """Sliding-window mean AQI per zone over non-null readings.

    Out: window_start, window_end, zone, rolling_avg_aqi (unrounded),
    readings.

    Batch input is aggregated per slide-sized pane (sum, count; partial
    aggregation before the shuffle).  Running sums over a zone's panes then give
    each window as the difference of two.  A window belongs to its first pane,
    so a pane yields only the windows that begin behind the pane before it: one
    row a result, no pane is copied into all windows that contain it.  Streams
    use ``window()`` directly, which watermarks and append mode need.
    """
    src = df.where(F.col("aqi").isNotNull())
    size, step = _seconds(window), _seconds(slide)
    if df.isStreaming or size % step != 0:
        agg = (_watermarked(src, time_col, delay)
               .groupBy(F.window(time_col, window, slide).alias("w"), key)
               .agg(F.avg("aqi").alias("rolling_avg_aqi"),
                    F.count("aqi").alias("readings")))
        return agg.select(F.col("w.start").alias("window_start"),
                          F.col("w.end").alias("window_end"), key,
                          "rolling_avg_aqi", "readings")
    exact = isinstance(df.schema["aqi"].dataType, IntegralType)
    # Differences of running sums are exact for whole numbers; others are summed
    # as decimals, as far as their type allows.
    value = F.col("aqi").cast("decimal(20,0)" if exact else "decimal(28,9)")
    panes = (src.groupBy(F.window(time_col, slide).alias("p"), key)
                .agg(F.sum(value).alias("_s"), F.count("aqi").alias("_n")))
    ntz = F.col("p.start").cast("timestamp_ntz")
    panes = panes.select(key, "_s", "_n", epoch_micros(ntz).alias("_at"), F.col("p.start").alias("_t"))
    k, us = size // step, step * 1_000_000
    order = Window.partitionBy(key).orderBy("_at")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    panes = (panes.withColumn("_sum", F.sum("_s").over(upto)).withColumn("_count", F.sum("_n").over(upto))
             .withColumn("_before", F.lag("_at").over(order)))
    ahead = F.collect_list(F.struct("_at", "_sum", "_count")).over(order.rowsBetween(0, k - 1))
    first = F.greatest(F.col("_before") + us, F.col("_at") - (k - 1) * us)
    rows = panes.withColumn("_ahead", ahead).withColumn(
        "_w", F.explode(F.sequence(first, F.col("_at"), F.lit(us).cast("long"))))
    end = F.col("_w") + (k - 1) * us
    last = F.element_at(F.filter("_ahead", lambda x: x["_at"] <= end), -1)
    rows = rows.withColumn("_last", last).withColumn(
        "window_start", F.timestamp_add("MICROSECOND", F.col("_w") - F.col("_at"), F.col("_t")))
    total, n = F.col("_last._sum") - (F.col("_sum") - F.col("_s")), F.col("_last._count") - (
        F.col("_count") - F.col("_n"))
    return rows.select(
        "window_start",
        (F.col("window_start") + F.make_dt_interval(secs=F.lit(size))).alias("window_end"),
        key, (total.cast("double") / n).alias("rolling_avg_aqi"), n.alias("readings"))

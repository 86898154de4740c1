"""Sensor streams and dimension tables derived from the driver's test tables.

The driver ships TPC-H-like tables plus an ``events`` table.  These functions
derive the four telemetry streams (meters, air quality, bus GPS, traffic
signals) from ``events`` and the two static tables (zones, routes) from
``nation`` with pure integer/double arithmetic that DuckDB repeats exactly in
``plans.oracle``.  Every derived row keeps ``event_id`` as the tie-break for
ordering, and ``event_time`` is the driver's TIMESTAMP_NTZ ``ts`` (UTC).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> F.Column:
    return c.cast("string")


def meter_readings(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    return events.select(
        F.concat(F.lit("MTR_"), _s(F.col("user_id") + 1000)).alias("meter_id"),
        F.concat(F.lit("W"), _s(F.col("user_id") % 5 + 1)).alias("ward_id"),
        F.col("value").alias("kwh_reading"),
        (F.lit(210.0) + (e % 300).cast("double") / F.lit(10.0)).alias("voltage"),
        (F.lit(0.85) + (e % 15).cast("double") / F.lit(100.0)).alias("power_factor"),
        F.col("ts").alias("event_time"), e.alias("event_id"))


def _or_26(k: F.Column, last: int) -> F.Column:
    """Key numbers 1 to ``last``, and 26 (beyond ``nation``) for what is left."""
    return F.when(k < last, k + 1).otherwise(26)


def air_quality(events: DataFrame) -> DataFrame:
    """AQI readings; nulls, > 300 and > 500 all occur."""
    e = F.col("event_id")
    return events.select(
        F.concat(F.lit("AQI_SENS_"), _s(F.col("user_id") % 51 + 100)).alias("sensor_id"),
        F.concat(F.lit("ZONE_"), _s(_or_26(F.col("user_id") % 10, 9))).alias("zone"),
        F.when(e % 20 != 0, F.floor(F.col("value") * 3.0).cast("int")).alias("aqi"),
        F.col("ts").alias("event_time"), e.alias("event_id"))


def bus_gps(events: DataFrame) -> DataFrame:
    """5 routes x 8 buses in a ~1.3 km box; some zero lat, some null lon."""
    e = F.col("event_id")
    return events.select(
        F.concat(F.lit("BUS_"), _s(F.col("user_id") % 40 + 1000)).alias("bus_id"),
        F.concat(F.lit("ROUTE_"), _s(_or_26(F.col("user_id") % 5, 4) * 101)).alias("route_id"),
        F.when(e % 97 == 0, F.lit(0.0))
         .otherwise(F.lit(19.0) + ((e * 37) % 120).cast("double") / F.lit(1e4)).alias("lat"),
        F.when(e % 89 != 0,
               F.lit(72.87) + ((e * 53) % 127).cast("double") / F.lit(1e4)).alias("lon"),
        F.col("ts").alias("event_time"), e.alias("event_id"))


def traffic_signals(events: DataFrame) -> DataFrame:
    """One signal cycle per event."""
    return events.select(
        F.concat(F.lit("J_"), _s(F.col("user_id") % 20 + 1)).alias("junction_id"),
        F.concat(F.lit("ZONE_"), _s(F.col("user_id") % 10 + 1)).alias("zone"),
        (F.col("value") * 4.0).alias("avg_wait_sec"),
        F.col("ts").alias("event_time"), F.col("event_id"))


def raw_messages(events: DataFrame) -> DataFrame:
    """Air-quality and GPS records of one mixed stream, as JSON bytes: one in
    50 is cut short, one in 70 is a bare number, one in 30 air records has a
    text for its AQI."""
    keep = {"ignoreNullFields": "false"}
    e = F.col("event_id")
    air = air_quality(events).select(
        F.lit("air_quality").alias("topic"), e, F.to_json(F.struct(
            "sensor_id", "zone", F.when(e % 30 == 1, F.lit("x"))
            .otherwise(F.col("aqi").cast("string")).alias("aqi"), "event_id"), keep).alias("v"))
    gps = bus_gps(events).select(
        F.lit("bus_gps").alias("topic"), e,
        F.to_json(F.struct("bus_id", "route_id", "lat", "lon", "event_id"), keep).alias("v"))
    v = (F.when(e % 50 == 7, F.expr("substring(v, 1, length(v) - 5)"))
         .when(e % 70 == 9, F.concat(F.lit("1"), _s(e))).otherwise(F.col("v")))
    return air.unionByName(gps).select("topic", "event_id", v.cast("binary").alias("value"))


def zone_profile(nation: DataFrame) -> DataFrame:
    """One zone a nation; readings of ZONE_26 have none (an inner join drops them)."""
    k = F.col("n_nationkey")
    return nation.select(
        F.concat(F.lit("ZONE_"), _s(k + 1)).alias("zone"),
        F.col("n_name").alias("zone_name"),
        (F.lit(100000) + k * 17000).alias("population"),
        (F.lit(4) + (k * 7) % 47).alias("num_schools"))


def route_schedule(nation: DataFrame) -> DataFrame:
    """One route a nation; positions on ROUTE_2626 have none (a left join keeps them)."""
    k = F.col("n_nationkey")
    return nation.select(
        F.concat(F.lit("ROUTE_"), _s((k + 1) * 101)).alias("route_id"),
        F.col("n_name").alias("route_name"),
        F.concat(F.lit("Terminal "), _s(F.col("n_regionkey"))).alias("terminal"),
        F.concat(F.lit("18:"), _s(k * 5 + 10), F.lit(":00")).alias("scheduled_arrival_time"))


class Fixtures:
    """Lazy access to the derived frames of one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    @property
    def events(self):
        return self.table("events")

    def meters(self):
        return meter_readings(self.events)

    def air(self):
        return air_quality(self.events)

    def gps(self):
        return bus_gps(self.events)

    def traffic(self):
        return traffic_signals(self.events)

    def zones(self):
        return zone_profile(self.table("nation"))

    def routes(self):
        return route_schedule(self.table("nation"))

"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables through ``sources.fixtures`` and runs
over the whole tables.  Output columns are aliased to the names used by the
DuckDB twins in ``plans.oracle``; window bounds are rendered as text and
event times as epoch ms so both engines print them the same way, and
doubles from sums/means of inexact inputs are rounded to 6 places.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from citystream.functions.json import parse_events, parsed_once, to_kv
from citystream.functions.time import epoch_millis, event_time
from citystream.operators import quality as Q
from citystream.operators.advisories import (advisories, advisories_sql, zone_advisories,
                                             zone_advisories_join_first)
from citystream.operators.bunching import bunching, latest_positions
from citystream.operators.enrich import enrich, enrich_json
from citystream.operators.gridlock import gridlock
from citystream.operators.incidents import (aqi_emergencies, incident_envelope,
                                            incident_messages, incidents)
from citystream.operators.summary import (advisory_preview, advisory_summary,
                                          advisory_totals)
from citystream.operators.windows import rolling_aqi, ward_energy
from citystream.schemas import ROUTE_SCHEDULE, SMART_METERS
from citystream.session import scratch_path
from citystream.sources.fixtures import Fixtures, raw_messages
from citystream.sources.streams import read_generations, read_lookup_csv, read_stored_parquet


def _r6(c):
    return F.round(c, 6)


def _text_window(df: DataFrame) -> DataFrame:
    return (df.withColumn("window_start", F.col("window_start").cast("string"))
              .withColumn("window_end", F.col("window_end").cast("string")))


def q_ward_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    out = ward_energy(fx.meters())
    return _text_window(out).select(
        "window_start", "window_end", "ward_id", "date",
        _r6("total_kwh_consumed").alias("total_kwh_consumed"),
        _r6("avg_power_factor").alias("avg_power_factor"),
        _r6("peak_voltage").alias("peak_voltage"))


def q_aqi_advisories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10 min / 2 min sliding mean per zone > 150, zone columns attached."""
    fx = Fixtures(spark, sf_dir)
    return _text_window(zone_advisories(fx.air(), fx.zones(), "10 minutes", "2 minutes"))


def _rolling_join(fx: Fixtures) -> DataFrame:
    return advisories(rolling_aqi(fx.air(), "10 minutes", "1 minute"), fx.zones())


def q_aqi_rolling_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10 min / 1 min sliding mean, joined to zones after aggregation."""
    return _text_window(_rolling_join(Fixtures(spark, sf_dir)))


def q_aqi_emergency(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    return aqi_emergencies(fx.air()).select(
        "incident_type", "severity", "sensor_id", "zone", "aqi", "message", "event_id",
        epoch_millis("event_time").alias("event_ms"))


def _validated(fx: Fixtures) -> DataFrame:
    """Both validated topics in one frame (original_topic, entity_id, ...)."""
    air = Q.validate(fx.air(), Q.AIR_QUALITY).select(
        F.lit(Q.AIR_QUALITY).alias("original_topic"),
        F.col("sensor_id").alias("entity_id"), "event_id", "event_time", "error_reason")
    gps = Q.validate(fx.gps(), Q.BUS_GPS).select(
        F.lit(Q.BUS_GPS).alias("original_topic"),
        F.col("bus_id").alias("entity_id"), "event_id", "event_time", "error_reason")
    return air.unionByName(gps)


def q_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    air = Q.dead_letters(Q.validate(fx.air(), Q.AIR_QUALITY), Q.AIR_QUALITY)
    gps = Q.dead_letters(Q.validate(fx.gps(), Q.BUS_GPS), Q.BUS_GPS)
    # As a consumer reads it: packed once, fields taken from the nested payload.
    value = to_kv(air.unionByName(gps), "original_topic").select("value")
    payload = F.get_json_object("value", "$.failed_payload")
    return value.select(
        F.get_json_object("value", "$.original_topic").alias("original_topic"),
        F.get_json_object("value", "$.error_reason").alias("error_reason"),
        F.coalesce(F.get_json_object(payload, "$.sensor_id"),
                   F.get_json_object(payload, "$.bus_id")).alias("entity_id"),
        F.get_json_object(payload, "$.aqi").alias("aqi"),
        F.array_join(F.array_sort(F.json_object_keys(payload)), ",").alias("payload_fields"),
        F.get_json_object("value", "$.event_id").cast("long").alias("event_id"),
        F.get_json_object("value", "$.failed_at").cast("long").alias("failed_at"))


def topic_dead_letters(validated: DataFrame) -> DataFrame:
    """Dead letters of mixed raw messages, read back from their JSON values."""
    kv = parsed_once(Q.dead_letter_messages(validated), "value", "letter")
    payload = F.try_variant_get("letter", "$.failed_payload", "variant")
    kind = F.schema_of_variant(payload)
    is_record = F.coalesce(kind.startswith("OBJECT"), F.lit(False))
    return kv.select(
        F.col("key").alias("original_topic"),
        F.try_variant_get("letter", "$.error_reason", "string").alias("error_reason"),
        F.try_variant_get("letter", "$.failed_payload.aqi", "string").alias("aqi"),
        (is_record & kind.rlike("[<, ]aqi:")).alias("has_aqi"),
        F.when(~is_record, F.try_variant_get("letter", "$.failed_payload", "string")).alias("raw"),
        F.try_variant_get("letter", "$.failed_payload.event_id", "long").alias("event_id"))


def q_topic_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One mixed stream of raw bytes: parse, dispatch on topic, rules, pack."""
    raw = raw_messages(Fixtures(spark, sf_dir).events)
    return topic_dead_letters(Q.validate_messages(raw))


def q_text_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as the producers write them: epoch milliseconds, text without a
    zone, ISO text with Z or an offset, and text that is no time."""
    g = Fixtures(spark, sf_dir).gps()
    k, t = F.col("event_id") % 6, F.date_trunc("second", "event_time")
    text = (F.when(k == 0, epoch_millis("event_time").cast("string"))
            .when(k == 1, F.date_format(t, "yyyy-MM-dd HH:mm:ss"))
            .when(k == 2, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(k == 3, F.date_format(t + F.expr("interval 330 minutes"), "yyyy-MM-dd HH:mm:ss'+05:30'"))
            .when(k == 4, F.date_format(t, "dd/MM/yyyy HH:mm")))
    sent = g.select("event_id", F.to_json(F.struct("bus_id", text.alias("timestamp"))).alias("value"))
    back = sent.select("event_id", F.from_json("value", "bus_id string, timestamp string").alias("d"))
    return back.select("event_id", F.col("d.bus_id").alias("bus_id"),
                       epoch_millis(event_time("d.timestamp")).alias("event_ms"))


def q_dead_letters_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters stamped with the time of processing, not of the event."""
    air = Q.validate(Fixtures(spark, sf_dir).air(), Q.AIR_QUALITY)
    begin = F.lit(int(time.time() * 1000))
    return Q.dead_letters(air, Q.AIR_QUALITY, time_col=None).select(
        "original_topic", "error_reason", "event_id",
        ((F.col("failed_at") >= begin) & (F.col("failed_at") < begin + 3_600_000)).alias("stamped_now"))


def q_valid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _validated(Fixtures(spark, sf_dir))
    return Q.valid_records(v).select("original_topic", "entity_id", "event_id")


def q_error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.error_counts(_validated(Fixtures(spark, sf_dir)))


def q_route_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions with the fields of their route, from a lookup CSV in which
    every route has an outdated row before its current one (the later wins)."""
    fx = Fixtures(spark, sf_dir)
    old = fx.routes().withColumn("route_name", F.lit("outdated"))
    path = scratch_path(spark, "route_schedule")
    old.unionByName(fx.routes()).coalesce(1).write.option("header", True).csv(path)
    routes = read_lookup_csv(spark, path, ROUTE_SCHEDULE, "route_id")
    return enrich(fx.gps(), routes, "route_id").select(
        "bus_id", "route_id", "lat", "lon", "event_id", "route_name", "terminal",
        "scheduled_arrival_time")


def _stored_advisories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advisories written as Parquet by one job and read back by another."""
    path = scratch_path(spark, "stored_advisories")
    rows = _text_window(_rolling_join(Fixtures(spark, sf_dir)))
    rows.write.parquet(path)
    return read_stored_parquet(spark, path, rows.schema)


def q_stored_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings stored by two generations of a writer, read as one table: the
    older has no event time and a narrower AQI."""
    air = Fixtures(spark, sf_dir).air()
    path = scratch_path(spark, "generations")
    old, new = F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1
    air.where(old).select("sensor_id", "zone", "aqi", "event_id").write.parquet(f"{path}/gen=1")
    air.where(new).select("event_id", F.col("aqi").cast("long").alias("aqi"), "sensor_id", "zone",
                          epoch_millis("event_time").alias("event_ms")).write.parquet(f"{path}/gen=2")
    return read_generations(spark, path).select("sensor_id", "zone", "aqi", "event_id", "event_ms")


def q_advisory_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return advisory_summary(_stored_advisories(spark, sf_dir))


def q_advisory_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return advisory_totals(_stored_advisories(spark, sf_dir))


def q_advisory_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return advisory_preview(_stored_advisories(spark, sf_dir))


def q_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack meter rows as (key, JSON) bytes, then parse them back."""
    fx = Fixtures(spark, sf_dir)
    m = fx.meters().withColumn("timestamp", epoch_millis("event_time"))
    kv = to_kv(m, "ward_id", "meter_id", "ward_id", "kwh_reading", "voltage",
               "power_factor", "timestamp", "event_id")
    wire = kv.select(F.col("key").cast("binary").alias("key"),
                     F.col("value").cast("binary").alias("value"))
    schema = StructType(SMART_METERS.fields + [StructField("event_id", LongType())])
    back = parse_events(wire.withColumn("key", F.col("key").cast("string")), schema,
                        keep=("key",))
    return back.select("key", "meter_id", "ward_id", "kwh_reading", "voltage",
                       "power_factor", "event_id",
                       epoch_millis(event_time("timestamp")).alias("event_ms"))


def q_gridlock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Junctions whose wait exceeds 180 s on 3 consecutive cycles."""
    g = gridlock(Fixtures(spark, sf_dir).traffic())
    w = F.col("consecutive_wait_times")
    return g.select("incident_type", "severity", "junction_id", "zone",
                    w[0].alias("wait_1"), w[1].alias("wait_2"), w[2].alias("wait_3"),
                    "message", "event_id", epoch_millis("event_time").alias("event_ms"))


def _valid_gps(fx: Fixtures) -> DataFrame:
    return Q.valid_records(Q.validate(fx.gps(), Q.BUS_GPS))


def q_bunching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buses of one route within 200 m for 300 s (validated GPS rows)."""
    b = bunching(_valid_gps(Fixtures(spark, sf_dir)))
    return b.select("incident_type", "severity", "route_id", "bus_1", "bus_2",
                    "distance_meters", "duration_seconds", "event_id",
                    epoch_millis("event_time").alias("event_ms"))


def _all_incidents(fx: Fixtures) -> DataFrame:
    return incidents(incident_envelope(aqi_emergencies(fx.air()), "sensor_id", "zone"),
                     incident_envelope(gridlock(fx.traffic()), "junction_id", "zone"),
                     incident_envelope(bunching(_valid_gps(fx)), "route_id"))


def q_incident_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All incidents as (key, JSON) messages, read back from the nested JSON."""
    kv = parsed_once(incident_messages(_all_incidents(Fixtures(spark, sf_dir))), "value", "m")

    def field(path: str, type_: str = "string"):
        return F.try_variant_get("m", f"$.{path}", type_)
    measure = F.coalesce(field("details.aqi", "double"),
                         field("details.consecutive_wait_times[0]", "double"),
                         field("details.distance_meters", "double"))
    return kv.select(
        "key", field("incident_type").alias("incident_type"), field("severity").alias("severity"),
        field("details.message").alias("message"), field("details.bus_1").alias("bus_1"),
        F.round(measure, 6).alias("measure"),
        F.size(field("details", "map<string,variant>")).alias("n_fields"),
        field("timestamp", "long").alias("timestamp"))


def q_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three detectors in one incident table (common envelope)."""
    allx = _all_incidents(Fixtures(spark, sf_dir))
    return allx.select("incident_type", "severity", "entity_id", "zone", "timestamp",
                       "event_id")


def q_aqi_rolling_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rolling join written as SQL over chained temp views."""
    fx = Fixtures(spark, sf_dir)
    return _text_window(advisories_sql(fx.air(), fx.zones(), "10 minutes", "1 minute"))


def q_aqi_advisories_join_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10/2 advisories with the join before the aggregation (JN2 plan)."""
    fx = Fixtures(spark, sf_dir)
    return _text_window(zone_advisories_join_first(fx.air(), fx.zones()))


def q_latest_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last valid position of each bus on each route."""
    p = latest_positions(_valid_gps(Fixtures(spark, sf_dir)))
    return p.select("route_id", "bus_id", "lat", "lon", "event_id",
                    epoch_millis("event_time").alias("event_ms"))


def q_open_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemaless GPS JSON (explicit nulls kept) enriched with route fields."""
    fx = Fixtures(spark, sf_dir)
    g = fx.gps()
    raw = g.select("event_id", F.to_json(F.struct("bus_id", "route_id", "lat", "lon", "event_id"),
                                         {"ignoreNullFields": "false"}).alias("value"))
    out = enrich_json(raw, fx.routes(), "route_id")
    keys = F.json_object_keys("enriched")
    return out.select(
        "event_id",
        F.get_json_object("enriched", "$.route_id").alias("route_id"),
        F.get_json_object("enriched", "$.route_name").alias("route_name"),
        F.get_json_object("enriched", "$.terminal").alias("terminal"),
        F.get_json_object("enriched", "$.scheduled_arrival_time").alias("scheduled_arrival_time"),
        F.size(keys).alias("n_fields"),
        F.array_contains(keys, "lon").alias("lon_key_kept"))


def q_bunching_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``q_bunching`` with narrow slices and pair buckets, so that every scan
    crosses slice edges and every level of buckets is used."""
    b = bunching(_valid_gps(Fixtures(spark, sf_dir)), seconds=3600, pair_seconds=30)
    return b.select("incident_type", "severity", "route_id", "bus_1", "bus_2",
                    "distance_meters", "duration_seconds", "event_id",
                    epoch_millis("event_time").alias("event_ms"))


def q_bunching_silent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bunching with a bus on each route that reports once, first, and then
    never again: its position stays valid for the whole span."""
    g = _valid_gps(Fixtures(spark, sf_dir))
    row = F.struct("event_time", "event_id", "lat", "lon")
    silent = (g.groupBy("route_id").agg(F.min(row).alias("r"))
              .select(F.lit("BUS_SILENT").alias("bus_id"), "route_id", "r.lat", "r.lon",
                      "r.event_time", (-F.col("r.event_id") - 1).alias("event_id")))
    b = bunching(g.unionByName(silent))
    return b.select("incident_type", "severity", "route_id", "bus_1", "bus_2",
                    "distance_meters", "duration_seconds", "event_id",
                    epoch_millis("event_time").alias("event_ms"))


QUERIES = {
    "q_ward_energy": q_ward_energy,
    "q_aqi_advisories": q_aqi_advisories,
    "q_aqi_rolling_join": q_aqi_rolling_join,
    "q_aqi_emergency": q_aqi_emergency,
    "q_dead_letters": q_dead_letters,
    "q_topic_dead_letters": q_topic_dead_letters,
    "q_incident_messages": q_incident_messages,
    "q_text_timestamps": q_text_timestamps,
    "q_dead_letters_now": q_dead_letters_now,
    "q_valid_events": q_valid_events,
    "q_error_counts": q_error_counts,
    "q_route_enrichment": q_route_enrichment,
    "q_stored_generations": q_stored_generations,
    "q_advisory_summary": q_advisory_summary,
    "q_advisory_totals": q_advisory_totals,
    "q_advisory_preview": q_advisory_preview,
    "q_json_roundtrip": q_json_roundtrip,
    "q_gridlock": q_gridlock,
    "q_bunching": q_bunching,
    "q_bunching_distributed": q_bunching_distributed,
    "q_bunching_silent": q_bunching_silent,
    "q_incidents": q_incidents,
    "q_aqi_rolling_sql": q_aqi_rolling_sql,
    "q_aqi_advisories_join_first": q_aqi_advisories_join_first,
    "q_latest_positions": q_latest_positions,
    "q_open_enrichment": q_open_enrichment,
}


def _register_streams() -> None:
    from citystream.streaming.jobs import STREAM_QUERIES
    QUERIES.update(STREAM_QUERIES)


_register_streams()

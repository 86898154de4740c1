"""Incident detectors and the common incident envelope.

Stateless: AQI emergency.  Stateful (see ``gridlock`` and ``bunching``):
junction gridlock and bus bunching.  Every detector returns flat columns
plus a ``details`` struct; ``incident_envelope`` turns any of them into the
common (incident_type, severity, details, timestamp) shape so they can be
unioned into one incident table.  ``details`` is a VARIANT object, packed once:
``incident_messages`` writes it as a nested JSON object, nulls kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citystream.functions.json import as_variant, to_kv
from citystream.functions.time import epoch_millis

# Incident labels, severities, messages and the AQI threshold.
AQI_EMERGENCY = "AQI_EMERGENCY"
TRAFFIC_GRIDLOCK = "TRAFFIC_GRIDLOCK"
BUS_BUNCHING = "BUS_BUNCHING"
CRITICAL, HIGH, MEDIUM = "CRITICAL", "HIGH", "MEDIUM"
AQI_MESSAGE = "AQI exceeded hazardous threshold (>300)"
GRIDLOCK_MESSAGE = "Junction gridlock detected! Wait time > 180s for 3 consecutive cycles."
AQI_EMERGENCY_THRESHOLD = 300


def aqi_emergencies(aqi: DataFrame, threshold: float = AQI_EMERGENCY_THRESHOLD) -> DataFrame:
    """Readings with a non-null AQI strictly above ``threshold``.

    Out: incident_type, severity, sensor_id, zone, aqi, message, event_id,
    event_time, details (struct).  Row-local: no shuffle, runs on streams.
    """
    hot = aqi.where(F.col("aqi").isNotNull() & (F.col("aqi") > F.lit(threshold)))
    return hot.select(
        F.lit(AQI_EMERGENCY).alias("incident_type"), F.lit(CRITICAL).alias("severity"),
        "sensor_id", "zone", "aqi", F.lit(AQI_MESSAGE).alias("message"),
        "event_id", "event_time",
        F.struct("sensor_id", "zone", "aqi", F.lit(AQI_MESSAGE).alias("message"))
        .alias("details"))


def incident_envelope(df: DataFrame, entity_col: str, zone_col: str | None = None) -> DataFrame:
    """Common incident shape for the union of all detectors.

    Out: incident_type, severity, entity_id, zone, details (VARIANT object),
    timestamp (event time, epoch ms), event_id.  The event time replaces the
    processing-time stamp so reruns give identical rows.
    """
    zone = F.col(zone_col) if zone_col else F.lit(None).cast("string")
    return df.select(
        "incident_type", "severity", F.col(entity_col).cast("string").alias("entity_id"),
        zone.alias("zone"), as_variant("details").alias("details"),
        epoch_millis("event_time").alias("timestamp"), "event_id")


def incidents(*enveloped: DataFrame) -> DataFrame:
    """Union of enveloped incident frames (by name)."""
    out = enveloped[0]
    for df in enveloped[1:]:
        out = out.unionByName(df)
    return out


def incident_messages(enveloped: DataFrame) -> DataFrame:
    """(key, value) for a message sink: key the entity, value one JSON object
    with the details nested in it."""
    return to_kv(enveloped, "entity_id", "incident_type", "severity", "details", "timestamp")

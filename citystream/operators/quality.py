"""Record validation, dead-letter routing and error counts.

Rules are data: an ordered list of (topic, predicate, reason).  The first
matching rule of the record's topic gives its ``error_reason``; no match means
valid (null reason).  A null or missing field counts as a value: a null AQI
hits the null rule, a null coordinate is read as 0 and fails the box rule.

Typed rows go through ``validate`` and ``dead_letters``; raw messages of mixed
topics through ``validate_messages``, which needs no schema: a value that is
no JSON object is ``UNPARSEABLE_JSON`` and its text is kept as it came.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citystream.functions.json import as_variant, parsed_once, to_kv
from citystream.functions.time import epoch_millis

# Reasons and rule bounds; topic names are this deployment's.
AIR_QUALITY = "air_quality"
BUS_GPS = "bus_gps"
NULL_AQI_VALUE = "NULL_AQI_VALUE"
OUT_OF_RANGE_AQI = "OUT_OF_RANGE_AQI"
UNPARSEABLE_JSON = "UNPARSEABLE_JSON"
IMPOSSIBLE_GPS_COORDINATES = "IMPOSSIBLE_GPS_COORDINATES"
AQI_MIN, AQI_MAX = 0, 500
LAT_MIN, LAT_MAX = 18.5, 19.5
LON_MIN, LON_MAX = 72.5, 73.5

Rule = tuple[str, Callable[[], Column], str]


def _gps_outside() -> Column:
    lat = F.coalesce(F.col("lat").cast("double"), F.lit(0.0))
    lon = F.coalesce(F.col("lon").cast("double"), F.lit(0.0))
    return ~(lat.between(LAT_MIN, LAT_MAX) & lon.between(LON_MIN, LON_MAX))


RULES: list[Rule] = [
    (AIR_QUALITY, lambda: F.col("aqi").isNull(), NULL_AQI_VALUE),
    (AIR_QUALITY, lambda: ~F.col("aqi").cast("double").between(AQI_MIN, AQI_MAX),
     OUT_OF_RANGE_AQI),
    (BUS_GPS, _gps_outside, IMPOSSIBLE_GPS_COORDINATES),
]


def error_reason(topic: str | Column, rules: Sequence[Rule] = RULES) -> Column:
    """CASE expression giving the first failing rule's reason, else null.

    ``topic`` is a literal topic (all rows from one topic; rules of other
    topics are left out at plan time) or a column holding the topic per row.
    """
    expr = None
    for t, pred, reason in rules:
        if isinstance(topic, str):
            if t != topic:
                continue
            cond = pred()
        else:
            cond = (topic == F.lit(t)) & pred()
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr if expr is not None else F.lit(None).cast("string")


def validate(df: DataFrame, topic: str | Column, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add ``error_reason`` (null when the record passes)."""
    return df.withColumn("error_reason", error_reason(topic, rules))


def dead_letters(validated: DataFrame, topic: str | Column,
                 time_col: str | None = "event_time",
                 payload_cols: Sequence[str] | None = None) -> DataFrame:
    """Failed records only: original_topic, error_reason, failed_payload, failed_at.

    ``failed_payload`` is the record as a VARIANT object with its nulls (the
    fields of ``payload_cols``, by default all but what the pipeline added:
    reason, event id and parsed event time), so topics with different schemas
    share one dead-letter table and the payload nests when it is packed.
    ``failed_at`` is the record's event time in epoch ms, which keeps the output
    deterministic; pass ``time_col=None`` for processing time.
    """
    added = {"error_reason", "event_id", "event_time", time_col}
    cols = payload_cols or [c for c in validated.columns if c not in added]
    top = F.lit(topic) if isinstance(topic, str) else topic
    at = (epoch_millis(time_col) if time_col
          else F.unix_millis(F.current_timestamp()))
    return validated.where(F.col("error_reason").isNotNull()).select(
        top.alias("original_topic"), "error_reason",
        as_variant(F.struct(*cols)).alias("failed_payload"),
        at.alias("failed_at"), *[c for c in ("event_id",) if c in validated.columns])


def validate_messages(messages: DataFrame, topic: str = "topic", value: str = "value") -> DataFrame:
    """Rules on raw messages of several topics (``value``: JSON bytes or text).

    Adds ``payload`` (VARIANT: the record, or the raw text where it is no JSON
    object) and ``error_reason``.  An AQI that is no number is out of range,
    not missing.  Topics without rules pass if they parse.
    """
    text, parsed = F.col(value).cast("string"), F.col("_parsed")
    is_record = F.schema_of_variant(parsed).startswith("OBJECT")
    record = F.when(is_record, parsed)
    aqi = F.try_variant_get(record, "$.aqi", "double")

    def coordinate(name: str) -> Column:
        return F.coalesce(F.try_variant_get(record, f"$.{name}", "double"), F.lit(0.0))
    outside = ~(coordinate("lat").between(LAT_MIN, LAT_MAX)
                & coordinate("lon").between(LON_MIN, LON_MAX))
    is_air, is_gps = F.col(topic) == AIR_QUALITY, F.col(topic) == BUS_GPS
    reason = (F.when(record.isNull(), UNPARSEABLE_JSON)
              .when(is_air & F.try_variant_get(record, "$.aqi", "string").isNull(), NULL_AQI_VALUE)
              .when(is_air & ~F.coalesce(aqi.between(AQI_MIN, AQI_MAX), F.lit(False)),
                    OUT_OF_RANGE_AQI)
              .when(is_gps & outside, IMPOSSIBLE_GPS_COORDINATES))
    return parsed_once(messages, value, "_parsed").select(
        *messages.columns, F.coalesce(record, text.cast("variant")).alias("payload"),
        reason.alias("error_reason"))


def dead_letter_messages(validated: DataFrame, topic: str = "topic") -> DataFrame:
    """Failed messages as (key, value): key the topic they came from, value a
    JSON object with topic, reason and the payload nested in it."""
    return to_kv(validated.where(F.col("error_reason").isNotNull()), topic,
                 F.col(topic).alias("original_topic"), "error_reason",
                 F.col("payload").alias("failed_payload"), keep_nulls=True)


def valid_records(validated: DataFrame) -> DataFrame:
    """The complement branch: records that passed every rule."""
    return validated.where(F.col("error_reason").isNull()).drop("error_reason")


def error_counts(validated: DataFrame) -> DataFrame:
    """Counts per reason over everything scanned, plus a scanned total.

    One aggregation: ROLLUP adds the grand-total row (``error_reason`` =
    'TOTAL_SCANNED'); passing records are counted under 'NONE'.  Works as a
    streaming aggregate in complete/update mode.
    """
    r = F.coalesce(F.col("error_reason"), F.lit("NONE")).alias("reason")
    return (validated.select(r).rollup("reason").agg(F.count(F.lit(1)).alias("n"))
            .select(F.coalesce("reason", F.lit("TOTAL_SCANNED")).alias("error_reason"),
                    F.col("n").alias("records")))


def observe_scan(validated: DataFrame, name: str = "dlq_scan"):
    """Attach running totals (records scanned, records failed) as observed
    metrics: collected with the query's own pass, no extra job.  Returns the
    frame and, for batch frames, the ``Observation`` to read after an action
    (streams report them in ``StreamingQueryProgress.observedMetrics``)."""
    from pyspark.sql import Observation
    metrics = [F.count(F.lit(1)).alias("scanned"), F.count("error_reason").alias("failed")]
    if validated.isStreaming:
        return validated.observe(name, *metrics), None
    obs = Observation(name)
    return validated.observe(obs, *metrics), obs

"""Validation rules, dead letters and counts on hand-made edge rows."""
import json

from citystream.operators import quality as Q


def _air(spark, vals):
    return spark.createDataFrame([(f"S{i}", "ZONE_1", v, i) for i, v in enumerate(vals)],
                                 "sensor_id string, zone string, aqi double, event_id long")


def test_aqi_rules(spark):
    vals = [None, -1.0, 0.0, 300.0, 301.0, 500.0, 501.0, 120.5, 77.0]
    got = [r.error_reason for r in Q.validate(_air(spark, vals), Q.AIR_QUALITY)
           .orderBy("event_id").collect()]
    assert got == ["NULL_AQI_VALUE", "OUT_OF_RANGE_AQI", None, None, None, None,
                   "OUT_OF_RANGE_AQI", None, None]


def test_gps_box(spark):
    pts = [(18.5, 72.5), (19.5, 73.5), (18.5, 73.5), (19.5, 72.5), (18.4999, 73.0),
           (19.5001, 73.0), (19.0, 72.4999), (19.0, 73.5001), (None, 73.0), (19.0, None),
           (0.0, 0.0)]
    df = spark.createDataFrame([(f"B{i}", la, lo, i) for i, (la, lo) in enumerate(pts)],
                               "bus_id string, lat double, lon double, event_id long")
    got = [r.error_reason for r in Q.validate(df, Q.BUS_GPS).orderBy("event_id").collect()]
    bad = "IMPOSSIBLE_GPS_COORDINATES"
    assert got == [None, None, None, None] + [bad] * 7


def test_topic_column_and_first_rule_wins(spark):
    df = spark.createDataFrame(
        [(Q.AIR_QUALITY, None, None, None), (Q.BUS_GPS, 600.0, 0.0, 0.0),
         (Q.AIR_QUALITY, 600.0, 0.0, 0.0), ("other", None, None, None)],
        "topic string, aqi double, lat double, lon double")
    got = [r.error_reason for r in Q.validate(df, df.topic).collect()]
    assert got == ["NULL_AQI_VALUE", "IMPOSSIBLE_GPS_COORDINATES", "OUT_OF_RANGE_AQI", None]


def test_dead_letters_and_counts(spark):
    v = Q.validate(_air(spark, [None, 10.0, 900.0]), Q.AIR_QUALITY)
    dl = Q.dead_letters(v, Q.AIR_QUALITY, time_col=None).orderBy("event_id").collect()
    assert [r.error_reason for r in dl] == ["NULL_AQI_VALUE", "OUT_OF_RANGE_AQI"]
    assert [json.loads(r.failed_payload.toJson()) for r in dl] == [
        {"sensor_id": "S0", "zone": "ZONE_1", "aqi": None},
        {"sensor_id": "S2", "zone": "ZONE_1", "aqi": 900.0}]
    assert all(r.failed_at > 0 for r in dl)
    counts = {r.error_reason: r.records for r in Q.error_counts(v).collect()}
    assert counts == {"NULL_AQI_VALUE": 1, "OUT_OF_RANGE_AQI": 1, "NONE": 1, "TOTAL_SCANNED": 3}
    assert [r.event_id for r in Q.valid_records(v).collect()] == [1]


def test_raw_messages_of_mixed_topics(spark):
    rows = [(Q.AIR_QUALITY, '{"sensor_id":"S","aqi":12.5,"x":{"y":null}}'),
            (Q.AIR_QUALITY, '{"sensor_id":"S","aqi":null}'), (Q.AIR_QUALITY, '{"sensor_id":"S"}'),
            (Q.AIR_QUALITY, '{"aqi":"x"}'), (Q.AIR_QUALITY, '{"aqi":501}'), (Q.AIR_QUALITY, "not json"),
            (Q.AIR_QUALITY, "[1]"), (Q.AIR_QUALITY, None), (Q.BUS_GPS, '{"lat":19.0,"lon":73.0}'),
            (Q.BUS_GPS, '{"lat":19.0}'), ("other", "{}"), ("other", "{")]
    df = spark.createDataFrame(rows, "topic string, v string").selectExpr(
        "topic", "cast(v as binary) as value")
    v = Q.validate_messages(df)
    assert [r.error_reason for r in v.collect()] == [
        None, "NULL_AQI_VALUE", "NULL_AQI_VALUE", "OUT_OF_RANGE_AQI", "OUT_OF_RANGE_AQI",
        "UNPARSEABLE_JSON", "UNPARSEABLE_JSON", "UNPARSEABLE_JSON", None,
        "IMPOSSIBLE_GPS_COORDINATES", None, "UNPARSEABLE_JSON"]
    letters = [json.loads(r.value) for r in Q.dead_letter_messages(v).collect()]
    assert letters[0]["failed_payload"] == {"sensor_id": "S", "aqi": None}
    assert letters[4]["failed_payload"] == "not json"
    assert letters[6]["failed_payload"] is None

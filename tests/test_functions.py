"""Scalar helpers: event-time parsing, zone-free conversions, haversine."""
import math

from pyspark.sql import functions as F

from citystream.functions.geo import haversine_m, sphere_cells
from tests.folds import metres
from citystream.functions.time import epoch_micros, event_time, ntz_to_utc, utc_to_ntz


def test_event_time_formats(spark):
    rows = [("1704067200000",), ("2024-01-01 00:00:00",), ("2024-01-01T00:00:00Z",),
            ("2024-01-01T00:00:00",), ("not a time",), (None,), ("  1704067200123 ",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(epoch_micros(event_time("s"))).collect()]
    base = 1704067200000000
    assert got == [base, base, base, base, None, None, base + 123000]


def test_event_time_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-01T00:00:00Z",),
                                    ("2024-01-01T05:30:00+05:30",)], "s string")
        got = [r[0] for r in df.select(epoch_micros(event_time("s"))).collect()]
        assert got == [1704067200000000] * 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_event_time_numeric_epoch_ms(spark):
    df = spark.createDataFrame([(1704067200000,)], "ms long")
    assert df.select(epoch_micros(event_time("ms"))).first()[0] == 1704067200000000


def test_zone_free_roundtrip(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 10:00:00.5' AS t")
        r = df.select(F.unix_micros(ntz_to_utc("t")).alias("u"),
                      utc_to_ntz(ntz_to_utc("t")).cast("string").alias("back")).first()
        assert r.u == 1704103200500000
        assert r.back == "2024-01-01 10:00:00.5"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_haversine_matches_python(spark):
    pts = [(19.0, 72.87, 19.0018, 72.87), (19.0, 72.87, 19.0, 72.8719),
           (-33.9, 151.2, -33.9005, 151.2003), (80.0, 10.0, 80.001, 10.01)]
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_m(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).collect()]
    for g, p in zip(got, pts):
        assert math.isclose(g, metres(p[:2], p[2:]), rel_tol=1e-6, abs_tol=1e-3)


def test_sphere_cells_neighbours_cover_radius(spark):
    # Points 200 m apart (any direction, several latitudes) sit in adjacent cells.
    rows = []
    for lat in (0.0, 19.07, 45.0, 75.0, -60.0):
        for bearing in range(0, 360, 30):
            d = 199.9 / 6371000.0
            la1, lo1 = math.radians(lat), math.radians(72.0)
            br = math.radians(bearing)
            la2 = math.asin(math.sin(la1) * math.cos(d) + math.cos(la1) * math.sin(d) * math.cos(br))
            lo2 = lo1 + math.atan2(math.sin(br) * math.sin(d) * math.cos(la1),
                                   math.cos(d) - math.sin(la1) * math.sin(la2))
            rows.append((lat, 72.0, math.degrees(la2), math.degrees(lo2)))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    c1 = sphere_cells(F.col("a"), F.col("b"), 200.0)
    c2 = sphere_cells(F.col("c"), F.col("d"), 200.0)
    out = df.select(*[F.abs(x - y).alias(f"d{i}") for i, (x, y) in enumerate(zip(c1, c2))]).collect()
    assert all(max(r) <= 1 for r in out)

"""Static sources, enrichment and the stored-output summary."""
import json

from pyspark.sql import functions as F

from citystream.functions.json import to_kv
from citystream.operators.enrich import enrich
from citystream.operators.summary import advisory_preview, advisory_summary, advisory_totals
from citystream.schemas import ROUTE_SCHEDULE, ZONE_PROFILE
from citystream.sources.streams import read_lookup_csv, read_static_csv, read_stored_parquet


def test_csv_with_schema_and_last_duplicate_wins(spark, tmp_path):
    p = tmp_path / "routes.csv"
    p.write_text("route_id,route_name,terminal,scheduled_arrival_time\n"
                 "R1,First,T1,18:00:00\nR2,Second,T2,18:30:00\nR1,Again,T9,19:00:00\n")
    look = read_lookup_csv(spark, str(p), ROUTE_SCHEDULE, "route_id")
    got = {r.route_id: r.route_name for r in look.collect()}
    assert got == {"R1": "Again", "R2": "Second"}
    z = tmp_path / "zones.csv"
    z.write_text("zone,zone_name,population,num_schools\nZONE_1,Core,450000,32\n")
    assert read_static_csv(spark, str(z), ZONE_PROFILE).first().population == 450000


def test_enrich_keeps_unmatched_and_json_omits_absent(spark):
    ev = spark.createDataFrame([("B1", "R1", None), ("B2", "R9", 5.0)],
                               "bus_id string, route_id string, speed_kmh double")
    rt = spark.createDataFrame([("R1", "First", "T1", "18:00:00")], ROUTE_SCHEDULE)
    out = enrich(ev, rt, "route_id").orderBy("bus_id")
    rows = out.collect()
    assert rows[0].route_name == "First" and rows[1].route_name is None
    js = [json.loads(r.value) for r in to_kv(out, "route_id").orderBy("key").collect()]
    assert "terminal" not in js[1] and js[0]["terminal"] == "T1"
    empty = spark.createDataFrame([], ROUTE_SCHEDULE)
    assert enrich(ev, empty, "route_id").count() == 2


def test_summary_over_stored_parquet(spark, tmp_path):
    d = tmp_path / "adv"
    a = spark.createDataFrame(
        [("2024-01-01 00:00:00", "ZONE_1", "Core", 151.0), ("2024-01-01 00:01:00", "ZONE_1", "Core", 160.0),
         ("2024-01-01 00:00:00", None, "X", 170.0), ("2024-01-01 00:02:00", "ZONE_2", "Port", 200.5)],
        "window_start string, zone string, zone_name string, rolling_avg_aqi double")
    a.write.parquet(str(d / "batch=1"))
    a.select("window_start", "zone", "rolling_avg_aqi").where(F.col("zone") == "ZONE_2") \
        .write.parquet(str(d / "batch=2" / "nested"))
    df = read_stored_parquet(spark, str(d), a.schema)
    summ = [tuple(r) for r in advisory_summary(df).collect()]
    # null zone dropped; the file without zone_name gives a null zone_name group
    assert ("ZONE_1", "Core", 2, 155.5, 160.0) in summ
    tot = advisory_totals(df).first()
    assert (tot.total_advisories, tot.unique_zones) == (5, 2)
    assert advisory_preview(df).count() == 5
    assert df.columns == a.columns
    (tmp_path / "empty").mkdir()
    for name in ("missing", "empty"):
        none = read_stored_parquet(spark, str(tmp_path / name), a.schema)
        assert none.count() == 0 and none.columns == a.columns
        assert advisory_summary(none).columns == advisory_summary(df).columns
    # Files without a suffix are found by their part- names.
    import shutil
    for i, f in enumerate(sorted((d / "batch=1").glob("*.parquet"))):
        (tmp_path / "bare").mkdir(exist_ok=True)
        shutil.copy(f, tmp_path / "bare" / f"part-{i:05d}")
    assert read_stored_parquet(spark, str(tmp_path / "bare"), a.schema).count() == 4


def test_open_enrichment_keeps_explicit_nulls(spark):
    from citystream.operators.enrich import enrich_json
    raw = spark.createDataFrame(
        [('{"bus_id":"B1","route_id":"R1","lat":null,"route_name":"old"}',),
         ('{"bus_id":"B2","route_id":"R9"}',), ("not json",), ("{}",)], "value string")
    rt = spark.createDataFrame([("R1", "First", "T1", "18:00:00")], ROUTE_SCHEDULE)
    out = [r.enriched for r in enrich_json(raw, rt).collect()]
    first = json.loads(out[0])
    assert first["lat"] is None and first["route_name"] == "First" and first["terminal"] == "T1"
    assert json.loads(out[1]) == {"bus_id": "B2", "route_id": "R9"}
    assert out[2] is None and json.loads(out[3]) == {}


def test_observed_scan_totals(spark):
    from citystream.operators import quality as Q
    df = spark.createDataFrame([(None,), (10.0,), (900.0,)], "aqi double")
    v, obs = Q.observe_scan(Q.validate(df, Q.AIR_QUALITY))
    v.write.format("noop").mode("overwrite").save()
    assert obs.get == {"scanned": 3, "failed": 2}


def test_kafka_options():
    from citystream.sources.streams import kafka_options
    o = kafka_options(["a", "b"], "h:1", max_per_trigger=100, min_partitions=24)
    assert o == {"kafka.bootstrap.servers": "h:1", "subscribe": "a,b",
                 "startingOffsets": "latest", "maxOffsetsPerTrigger": "100",
                 "minPartitions": "24"}


def test_broadcast_only_behind_size_check(spark):
    from citystream.operators.joins import small_side
    dim = spark.range(50).withColumnRenamed("id", "k")
    fact = spark.range(1000).select((F.col("id") % 50).alias("k"))

    def plan(d):
        return fact.join(d, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(small_side(dim, max_bytes=1 << 20)).lower()
    assert "broadcast" not in plan(small_side(dim, max_bytes=10)).lower()


def test_unkeyed_messages_and_rate_source(spark, tmp_path):
    from citystream.sources.streams import read_stream
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    row = to_kv(df, None).first()
    assert row.key is None and json.loads(row.value) == {"x": "a", "y": 1}
    s = read_stream(spark, "rate", rowsPerSecond=5, numPartitions=1)
    assert s.isStreaming and set(s.columns) == {"timestamp", "value"}

"""Progress as data, sinks behind commit records, periodic counts, schemas over
generations of files, file order of lookups, windows from running sums."""
import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (DecimalType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from citystream.operators.windows import rolling_aqi
from citystream.schemas import ROUTE_SCHEDULE
from citystream.sources import streams as S
from citystream.streaming.progress import file_backlog, progress_row
from citystream.streaming.sinks import EpochManifest, fan_out_committed, kv_sink, parquet_sink

T0 = dt.datetime(2024, 1, 1)


def test_progress_rows():
    report = {"name": "q", "runId": "r", "batchId": 3, "numInputRows": 10,
              "eventTime": {"watermark": "2024-01-01T00:00:00.000Z"},
              "stateOperators": [{"numRowsDroppedByWatermark": 2, "numRowsTotal": 5},
                                 {"numRowsDroppedByWatermark": 1, "numRowsTotal": 7}],
              "sources": [{"endOffset": {"t": {"0": 10, "1": 5}}, "latestOffset": {"t": {"0": 14, "1": 5, "2": 3}}},
                          {"endOffset": {"logOffset": 3}, "latestOffset": None}]}
    assert progress_row(report) == ("q", "r", 3, 10, 3, 12, 7, "2024-01-01T00:00:00.000Z")
    assert progress_row({"batchId": 0, "numInputRows": 0})[4:] == (0, 0, None, None)


def test_late_rows_are_reported(spark, sf_dir):
    from citystream.streaming.jobs import q_stream_late_rows
    rows = q_stream_late_rows(spark, sf_dir).collect()
    n = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    assert [tuple(r) for r in rows] == [(n, True)]


def _stream(spark, tmp_path, files):
    for i in range(files):
        (spark.createDataFrame([(f"Z{j % 3}", j, i * 10 + j) for j in range(5)],
                               "zone string, v long, id long")
         .coalesce(1).write.parquet(str(tmp_path / "in" / f"f{i}")))
    return (spark.readStream.schema("zone string, v long, id long").option("maxFilesPerTrigger", 2)
            .option("recursiveFileLookup", True).parquet(str(tmp_path / "in")))


def test_backlog_by_trigger(spark, tmp_path):
    ck = str(tmp_path / "ck")
    q = (_stream(spark, tmp_path, 7).writeStream.format("noop").option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(tuple(r) for r in file_backlog(spark, ck).collect())
    assert got == [(0, 2, 5), (1, 2, 3), (2, 2, 1), (3, 1, 0)]


def test_both_sinks_show_or_none(spark, tmp_path):
    """A batch killed between its sinks is repeated; readers never see one sink only."""
    root, ck, src = str(tmp_path / "out"), str(tmp_path / "ck"), _stream(spark, tmp_path, 3)
    broken = {"on": True}

    def dies(batch, folder):
        kv_sink("zone")(batch, folder)
        if broken["on"] and "epoch=1/" in folder:
            raise RuntimeError("killed")
    sinks = {"a_table": parquet_sink, "b_messages": dies}
    q = fan_out_committed(src, sinks, root, ck, "append")
    with pytest.raises(Exception):
        q.awaitTermination()
    spark.streams.resetTerminated()
    m = EpochManifest(spark, root)

    def ids():
        table = m.read("a_table", "zone string, v long, id long")
        kv = m.read("b_messages", "key string, value string", "json")
        told = kv.select(F.get_json_object("value", "$.id").cast("long").alias("id"))
        return (sorted(r.id for r in table.collect()), sorted(r.id for r in told.collect()))
    table, told = ids()
    assert table == told and len(table) == 10
    # Both writers of epoch 1 had written; only the record is missing.
    assert spark.read.parquet(f"{root}/a_table/epoch=1").count() == 5
    broken["on"] = False
    fan_out_committed(src, sinks, root, ck, "append").awaitTermination()
    table, told = ids()
    assert table == told == sorted(i * 10 + j for i in range(3) for j in range(5))
    # An epoch that has its record is not written again.
    m.writer(sinks)(spark.createDataFrame([("Z", 1, 999)], "zone string, v long, id long"), 0)
    assert 999 not in ids()[0]
    assert EpochManifest(spark, str(tmp_path / "none")).read("a", "x long").count() == 0


def test_periodic_counts_are_told_only_for_new_rows(spark, tmp_path):
    from citystream.streaming.periodic import periodic_counts, run_until
    src = tmp_path / "in"
    rows = [("BAD" if i % 3 == 0 else None, i) for i in range(30)]
    schema = "error_reason string, event_id long"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(src / "f0"))
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(src))
    q = (periodic_counts(stream, 200, 1).writeStream.format("memory").queryName("periodic")
         .option("checkpointLocation", str(tmp_path / "ck")).outputMode("append")
         .trigger(processingTime="200 milliseconds").start())
    run_until(q, lambda: spark.table("periodic").count() >= 2)
    got = {r.error_reason: r.records for r in spark.table("periodic").collect()}
    assert got == {"BAD": 10, "NONE": 20}
    # After a restart timers still fire, but without rows nothing is told.
    told = []
    q = (periodic_counts(stream, 200, 1).writeStream.foreachBatch(lambda b, i: told.append(b.count()))
         .option("checkpointLocation", str(tmp_path / "ck")).outputMode("append")
         .trigger(processingTime="200 milliseconds").start())
    import time
    end = time.time() + 30
    while len(told) < 4 and time.time() < end:
        time.sleep(0.3)
    q.stop()
    assert len(told) >= 4 and not any(told)


def test_union_of_schemas():
    a = StructType([StructField("x", IntegerType()), StructField("s", StringType()),
                    StructField("d", DecimalType(5, 2)), StructField("n", StructType([StructField("i", IntegerType())]))])
    b = StructType([StructField("y", DoubleType()), StructField("x", LongType()),
                    StructField("d", DecimalType(6, 4)), StructField("n", StructType([StructField("j", LongType())]))])
    got = S.union_schema([a, b])
    assert [(f.name, f.dataType.simpleString()) for f in got] == [
        ("x", "bigint"), ("s", "string"), ("d", "decimal(7,4)"), ("n", "struct<i:int,j:bigint>"), ("y", "double")]
    with pytest.raises(ValueError, match="column x"):
        S.union_schema([a, StructType([StructField("x", StringType())])])


def test_generations_of_files(spark, tmp_path):
    path = str(tmp_path / "g")
    spark.range(5).selectExpr("cast(id as int) as a", "'old' as b").write.parquet(f"{path}/1")
    spark.range(5, 8).selectExpr("id as a", "cast(id as float) as c").write.parquet(f"{path}/2")
    spark.range(8, 9).selectExpr("cast(id as double) as c", "id + 5000000000 as a").write.parquet(f"{path}/3")
    got = S.read_generations(spark, path)
    assert dict(got.dtypes) == {"a": "bigint", "b": "string", "c": "double"}
    rows = sorted((r.a, r.b, r.c) for r in got.collect())
    assert rows == [(i, "old", None) for i in range(5)] + [(i, None, float(i)) for i in range(5, 8)] + [
        (5000000008, None, 8.0)]
    assert S.read_generations(spark, str(tmp_path / "none")) is None


def test_last_duplicate_wins_over_files_and_splits(spark, tmp_path):
    n, folder = 4000, tmp_path / "csv"
    folder.mkdir()
    for f in range(3):
        with open(folder / f"part-{f}.csv", "w") as out:
            out.write("route_id,route_name,terminal,scheduled_arrival_time\n")
            for i in range(n):
                out.write(f"R{i % 7},name-{f}-{i},T,18:00:00\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = S.read_lookup_csv(spark, str(folder), ROUTE_SCHEDULE, "route_id")
        assert S.read_static_csv(spark, str(folder), ROUTE_SCHEDULE).rdd.getNumPartitions() > 10
        got = {r.route_id: r.route_name for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {f"R{k}": f"name-2-{max(i for i in range(n) if i % 7 == k)}" for k in range(7)}


@pytest.mark.parametrize("kind", ["int", "double", "decimal(6,2)"])
def test_windows_from_running_sums(spark, kind):
    rnd = random.Random(3)
    rows = []
    for zone, span in (("dense", 40), ("sparse", 900), ("one", 1)):
        for i in range(60 if span > 1 else 1):
            rows.append((zone, None if rnd.random() < 0.1 else rnd.randrange(0, 40_000) / (1 if kind == "int" else 100),
                         T0 + dt.timedelta(seconds=rnd.randrange(span * 60))))
    df = spark.createDataFrame(rows, "zone string, x double, event_time timestamp_ntz").select(
        "zone", F.col("x").cast(kind).alias("aqi"), "event_time")
    want = {}
    for zone, x, t in rows:
        if x is None:
            continue
        v = int(x) if kind == "int" else Decimal(str(x))
        minute = int((t - T0).total_seconds() // 120)
        for k in range(5):
            want.setdefault((zone, T0 + dt.timedelta(minutes=2 * (minute - k))), []).append(v)
    got = {(r.zone, r.window_start): (r.window_end - r.window_start, r.readings, r.rolling_avg_aqi)
           for r in rolling_aqi(df, "10 minutes", "2 minutes").collect()}
    assert got.keys() == want.keys()
    for k, (width, n, mean) in got.items():
        assert width == dt.timedelta(minutes=10) and n == len(want[k])
        assert mean == pytest.approx(float(sum(want[k])) / n, rel=1e-12)


def test_partials_of_epochs_merge(spark, tmp_path):
    """A repeated epoch does not count twice; numbers over several buckets."""
    from citystream.streaming.merged import count_by_epoch, merged_counts
    src, path, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    schema = "error_reason string, n long"
    data = [[(None, 5), ("BAD", 40_000), (None, None)], [("BAD", 5), (None, 70_000), (None, 0)]]
    q = None
    for i, rows in enumerate(data):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(src / f"f{i}"))
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(src))
        q = count_by_epoch(stream, F.col("n"), path, ck)
        q.awaitTermination()
    assert [tuple(r) for r in merged_counts(spark, path).collect()] == [(6, 2, 4)]
    import shutil
    shutil.copytree(f"{ck}/offsets", str(tmp_path / "seen"))  # two epochs were run
    assert {"0", "1"} <= {f.name for f in (tmp_path / "seen").iterdir()}

"""Structured Streaming jobs over the driver's tables.

The file source reads ``events.parquet`` from a scale-factor folder as a
stream (``pathGlobFilter``), the fixture projections derive the sensor
streams from it, and each job writes to a sink below the shared checkpoint
folder, runs with ``availableNow`` and returns the sink read back as a
batch frame.  Event time enters the stream as TIMESTAMP (watermarks need
it) and leaves as UTC wall time, independent of the session zone.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.functions.time import epoch_micros, ntz_to_utc, utc_to_ntz
from citystream.operators import quality as Q
from citystream.operators.advisories import advisories_sql, zone_advisories
from citystream.operators.windows import rolling_aqi, ward_energy
from citystream.session import scratch_path
from citystream.sources import fixtures as fx
from citystream.sources.streams import read_stream
from citystream.streaming.periodic import periodic_counts, run_until
from citystream.streaming.progress import ProgressLog, file_backlog
from citystream.streaming.sinks import (EpochManifest, await_all, epoch_writer, fan_out,
                                        fan_out_committed, kv_json_writer, kv_sink, parquet_sink,
                                        to_parquet)
from citystream.streaming.merged import count_by_epoch, merged_counts
from citystream.streaming.ordered import bunching_ordered, gridlock_ordered
from citystream.streaming.stateful import bunching_stream, gridlock_stream


def event_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None,
                 path: str | None = None) -> DataFrame:
    """``events`` rows as a stream: the driver file, or files under ``path``."""
    schema = fx.table(spark, sf_dir, "events").schema
    opts = {} if path else {"pathGlobFilter": "events.parquet"}
    if max_files:
        opts["maxFilesPerTrigger"] = max_files
    return read_stream(spark, "file", path=path or sf_dir, schema=schema, fmt="parquet", **opts)


def _utc(df: DataFrame) -> DataFrame:
    return df.withColumn("event_time", ntz_to_utc("event_time"))


def _run(q) -> None:
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))


def q_stream_ward_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ward energy as a stream: 45-minute watermark, append mode, Parquet
    partitioned by (ward_id, date).  Only closed windows are emitted."""
    agg = ward_energy(_utc(fx.meter_readings(event_stream(spark, sf_dir))),
                      delay="45 minutes")
    start, end = utc_to_ntz("window_start"), utc_to_ntz("window_end")
    out = agg.select(start.cast("string").alias("window_start"),
                     end.cast("string").alias("window_end"), "ward_id",
                     F.date_format(start, "yyyy-MM-dd").alias("date"),
                     "total_kwh_consumed", "avg_power_factor", "peak_voltage")
    path = scratch_path(spark, "ward_energy")
    _run(to_parquet(out, path, scratch_path(spark, "ward_energy_ckpt"), "append",
                    partition_by=("ward_id", "date")))
    back = spark.read.schema(
        "window_start string, window_end string, total_kwh_consumed double, "
        "avg_power_factor double, peak_voltage double, ward_id string, date string"
    ).parquet(path)
    return back.select("window_start", "window_end", "ward_id", "date",
                       F.round("total_kwh_consumed", 6).alias("total_kwh_consumed"),
                       F.round("avg_power_factor", 6).alias("avg_power_factor"),
                       F.round("peak_voltage", 6).alias("peak_voltage"))


def q_stream_advisories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advisories as a stream in update mode (10-minute watermark).  One
    query fans each micro-batch out to two sinks: a per-epoch Parquet table
    and the message-sink shape (key = zone, JSON of all fields).  The last
    update per (zone, window) of the table is the result."""
    air = _utc(fx.air_quality(event_stream(spark, sf_dir)))
    zones = fx.zone_profile(fx.table(spark, sf_dir, "nation"))
    adv = zone_advisories(air, zones, "10 minutes", "2 minutes", delay="10 minutes")
    adv = (adv.withColumn("window_start", utc_to_ntz("window_start").cast("string"))
              .withColumn("window_end", utc_to_ntz("window_end").cast("string")))
    path = scratch_path(spark, "advisories")
    _run(fan_out(adv, [epoch_writer(path), kv_json_writer(scratch_path(spark, "advisories_kv"),
                                                          "zone")],
                 scratch_path(spark, "advisories_ckpt"), "update"))
    back = spark.read.parquet(path)
    cols = [c for c in adv.columns if c not in ("zone", "window_start")]
    last = F.max_by(F.struct(*cols), F.col("epoch"))
    return (back.groupBy("zone", "window_start").agg(last.alias("_v"))
                .select("window_start", F.col("_v.window_end").alias("window_end"), "zone",
                        *[F.col(f"_v.{c}").alias(c) for c in cols if c != "window_end"]))


def q_stream_gridlock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gridlock through keyed streaming state; same rows as ``q_gridlock``."""
    alerts = gridlock_stream(_utc(fx.traffic_signals(event_stream(spark, sf_dir))))
    path = scratch_path(spark, "gridlock")
    _run(to_parquet(alerts, path, scratch_path(spark, "gridlock_ckpt")))
    from citystream.operators.incidents import GRIDLOCK_MESSAGE, HIGH, TRAFFIC_GRIDLOCK
    return spark.read.schema(alerts.schema).parquet(path).select(
        F.lit(TRAFFIC_GRIDLOCK).alias("incident_type"), F.lit(HIGH).alias("severity"),
        "junction_id", "zone", "wait_1", "wait_2", "wait_3",
        F.lit(GRIDLOCK_MESSAGE).alias("message"), "event_id",
        F.floor(F.col("event_us") / 1000).cast("long").alias("event_ms"))


def q_stream_bunching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bunching through keyed streaming state on validated GPS rows; same
    rows as ``q_bunching``."""
    gps = Q.valid_records(Q.validate(_utc(fx.bus_gps(event_stream(spark, sf_dir))), Q.BUS_GPS))
    alerts = bunching_stream(gps)
    path = scratch_path(spark, "bunching")
    _run(to_parquet(alerts, path, scratch_path(spark, "bunching_ckpt")))
    from citystream.operators.incidents import BUS_BUNCHING, MEDIUM
    return spark.read.schema(alerts.schema).parquet(path).select(
        F.lit(BUS_BUNCHING).alias("incident_type"), F.lit(MEDIUM).alias("severity"),
        "route_id", "bus_1", "bus_2", "distance_meters", "duration_seconds", "event_id",
        F.floor(F.col("event_us") / 1000).cast("long").alias("event_ms"))


# The ordered jobs' input: slots of event time, with one row in five a slot late,
# in files of a few hash buckets each; and a watermark delay that covers that
# disorder.  All are fixed spans, so longer histories make more batches.
SLOT_DAYS, LATE_EVERY, SLOT_BUCKETS = 4, 5, 4
LATE_DELAY = f"{2 * SLOT_DAYS * 86400 + 1} seconds"
#: Width of the detectors' slots of waiting rows; silence after which a bus goes.
WAIT_SLOT_SECONDS, SILENT_SECONDS = 6 * 3600, 12 * 3600


def _arrive_in_order(spark: SparkSession, path: str) -> None:
    """File streams read files by age: give those of slot i the i-th second."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    slots = sorted((int(s.getPath().getName().split("=")[1]), s.getPath())
                   for s in fs.listStatus(jpath) if "=" in s.getPath().getName())
    for i, (_, folder) in enumerate(slots):
        for f in fs.listStatus(folder):
            fs.setTimes(f.getPath(), 1_600_000_000_000 + 1000 * i, -1)


def _write_slots(ev: DataFrame, slot, path: str) -> None:
    """Rows by slot, a slot in ``SLOT_BUCKETS`` files of their own."""
    bucket = F.pmod("event_id", F.lit(SLOT_BUCKETS))
    (ev.withColumn("slot", slot * SLOT_BUCKETS + bucket).repartition("slot")
       .write.mode("append").partitionBy("slot").parquet(path))


def _late_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a stream of several micro-batches whose rows come out of
    order by up to two slots (``LATE_DELAY`` waits for all of them), closed by a
    marker: one more row so much later that the watermark passes all others."""
    ev = fx.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    width = SLOT_DAYS * 86_400_000_000
    slot = (F.floor(epoch_micros("ts") / width)
            + F.when(F.col("event_id") % LATE_EVERY == 0, 1).otherwise(0))
    path = scratch_path(spark, "late_slots")
    _write_slots(ev, slot, path)
    # The marker has a position and a signal; nothing later releases it.
    last = ev.agg(F.max("ts").alias("last"))
    marker = (ev.where("event_id % 97 <> 0 and event_id % 89 <> 0").orderBy("event_id").limit(1)
              .join(F.broadcast(last)).withColumn("ts", F.expr(f"last + interval {5 * SLOT_DAYS} days"))
              .select(*ev.columns))
    _write_slots(marker, F.floor(epoch_micros("ts") / width), path)
    _arrive_in_order(spark, path)
    return (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", SLOT_BUCKETS)
            .option("recursiveFileLookup", True).parquet(path))


def q_stream_gridlock_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gridlock in event order over many micro-batches with late rows: all
    alerts of the batch operator."""
    alerts = gridlock_ordered(_utc(fx.traffic_signals(_late_slots(spark, sf_dir))),
                              delay=LATE_DELAY, slot_s=WAIT_SLOT_SECONDS)
    path = scratch_path(spark, "gridlock_ordered")
    _run(to_parquet(alerts, path, scratch_path(spark, "gridlock_ordered_ckpt")))
    from citystream.operators.incidents import GRIDLOCK_MESSAGE, HIGH, TRAFFIC_GRIDLOCK
    return spark.read.schema(alerts.schema).parquet(path).select(
        F.lit(TRAFFIC_GRIDLOCK).alias("incident_type"), F.lit(HIGH).alias("severity"),
        "junction_id", "zone", "wait_1", "wait_2", "wait_3",
        F.lit(GRIDLOCK_MESSAGE).alias("message"), "event_id",
        F.floor(F.col("event_us") / 1000).cast("long").alias("event_ms"))


def _bunching_in_order(spark: SparkSession, sf_dir: str, name: str, silent_s: int | None) -> DataFrame:
    gps = Q.valid_records(Q.validate(_utc(fx.bus_gps(_late_slots(spark, sf_dir))), Q.BUS_GPS))
    alerts = bunching_ordered(gps, delay=LATE_DELAY, slot_s=WAIT_SLOT_SECONDS, silent_s=silent_s)
    path = scratch_path(spark, name)
    _run(to_parquet(alerts, path, scratch_path(spark, f"{name}_ckpt")))
    from citystream.operators.incidents import BUS_BUNCHING, MEDIUM
    return spark.read.schema(alerts.schema).parquet(path).select(
        F.lit(BUS_BUNCHING).alias("incident_type"), F.lit(MEDIUM).alias("severity"),
        "route_id", "bus_1", "bus_2", "distance_meters", "duration_seconds", "event_id",
        F.floor(F.col("event_us") / 1000).cast("long").alias("event_ms"))


def q_stream_bunching_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bunching in event order over many micro-batches with late rows: all
    alerts of the batch operator."""
    return _bunching_in_order(spark, sf_dir, "bunching_ordered", None)


def q_stream_bunching_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with state that forgets: a bus silent for over ``SILENT_SECONDS``
    leaves with its pair timers and comes back as a new one."""
    return _bunching_in_order(spark, sf_dir, "bunching_state", SILENT_SECONDS)


def stream_error_counts(validated: DataFrame, path: str, checkpoint: str,
                        trigger: dict | None = None):
    """Running dead-letter counts (per reason + scanned total) as a complete-
    mode streaming aggregate, e.g. ``trigger={"processingTime": "30 seconds"}``
    for a periodic summary.  Each epoch's full table goes to ``path/epoch=N``."""
    return fan_out(Q.error_counts(validated), [epoch_writer(path)], checkpoint,
                   mode="complete", trigger=trigger)


def q_stream_error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both validated topics merged into one stream; the last complete table."""
    air = Q.validate(fx.air_quality(event_stream(spark, sf_dir)), Q.AIR_QUALITY)
    gps = Q.validate(fx.bus_gps(event_stream(spark, sf_dir)), Q.BUS_GPS)
    merged = air.select("error_reason").unionByName(gps.select("error_reason"))
    path = scratch_path(spark, "error_counts")
    _run(stream_error_counts(merged, path, scratch_path(spark, "error_counts_ckpt")))
    back = spark.read.parquet(path)
    last = back.agg(F.max("epoch").alias("epoch"))
    return back.join(last, "epoch").select("error_reason", "records")


def q_stream_topic_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed raw stream through rules to (key, value) dead letters."""
    from citystream.plans.queries import topic_dead_letters
    raw = fx.raw_messages(event_stream(spark, sf_dir))
    out = topic_dead_letters(Q.validate_messages(raw))
    path = scratch_path(spark, "topic_letters")
    _run(to_parquet(out, path, scratch_path(spark, "topic_letters_ckpt")))
    return spark.read.schema(out.schema).parquet(path)


def q_stream_advisories_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advisories by the SQL form on a stream, update mode."""
    air = _utc(fx.air_quality(event_stream(spark, sf_dir)))
    zones = fx.zone_profile(fx.table(spark, sf_dir, "nation"))
    adv = advisories_sql(air, zones, "10 minutes", "2 minutes", delay="10 minutes")
    adv = (adv.withColumn("window_start", utc_to_ntz("window_start").cast("string"))
              .withColumn("window_end", utc_to_ntz("window_end").cast("string")))
    path = scratch_path(spark, "advisories_sql")
    _run(fan_out(adv, [epoch_writer(path)], scratch_path(spark, "advisories_sql_ckpt"), "update"))
    return _last_update(spark.read.parquet(path), ["zone", "window_start"]).select(*adv.columns)


def _last_update(epochs: DataFrame, keys: list[str]) -> DataFrame:
    """The last row of each key over the epochs of an update-mode table."""
    rest = [c for c in epochs.columns if c not in (*keys, "epoch")]
    return (epochs.groupBy(*keys).agg(F.max_by(F.struct(*rest), "epoch").alias("v"))
            .select(*keys, "v.*"))


def q_stream_ward_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ward energy as (key = ward, JSON value) messages in update mode, read
    back; the last message of each ward and window counts."""
    agg = ward_energy(_utc(fx.meter_readings(event_stream(spark, sf_dir))), delay="45 minutes")
    start, end = utc_to_ntz("window_start"), utc_to_ntz("window_end")
    out = agg.select(start.cast("string").alias("window_start"),
                     end.cast("string").alias("window_end"), "ward_id",
                     F.date_format(start, "yyyy-MM-dd").alias("date"),
                     "total_kwh_consumed", "avg_power_factor", "peak_voltage")
    path = scratch_path(spark, "ward_messages")
    _run(fan_out(out, [kv_json_writer(path, "ward_id")],
                 scratch_path(spark, "ward_messages_ckpt"), "update"))
    kv = spark.read.schema("key string, value string, epoch long").json(path)
    rows = (kv.select("epoch", F.from_json("value", out.schema).alias("d")).select("epoch", "d.*"))
    last = _last_update(rows, ["ward_id", "window_start"])
    return last.select("window_start", "window_end", "ward_id", "date",
                       *[F.round(c, 6).alias(c) for c in
                         ("total_kwh_consumed", "avg_power_factor", "peak_voltage")])


# Files per micro-batch of the paced consumer; buckets that a day is cut into, so
# that no task writes or reads a whole day.
PACED_FILES_PER_TRIGGER = 4
PACED_BUCKETS = 4


def _consumers(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """Two consumers of one signal stream: an unthrottled one and a paced one (a
    few files a micro-batch).  -> (output of either, the paced one's checkpoint)."""
    days = scratch_path(spark, "signals_by_day")
    ev = fx.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    schema = ev.schema
    parts = ev.withColumn("slot", F.floor(epoch_micros("ts") / 86_400_000_000) * PACED_BUCKETS
                          + F.pmod("event_id", F.lit(PACED_BUCKETS)))
    parts.repartition("slot").write.partitionBy("slot").parquet(days)
    _arrive_in_order(spark, days)
    flat = {"recursiveFileLookup": True}
    fast_src = read_stream(spark, "file", path=days, schema=schema, fmt="parquet", **flat)
    slow_src = read_stream(spark, "file", path=days, schema=schema, fmt="parquet",
                           maxFilesPerTrigger=PACED_FILES_PER_TRIGGER, **flat)
    cols = ("junction_id", "zone", "avg_wait_sec", "event_id")
    fast_out, slow_out = scratch_path(spark, "fast"), scratch_path(spark, "slow")
    checkpoint = scratch_path(spark, "slow_ckpt")
    fast = to_parquet(fx.traffic_signals(fast_src).select(*cols), fast_out,
                      scratch_path(spark, "fast_ckpt"))
    slow = to_parquet(fx.traffic_signals(slow_src).select(*cols), slow_out, checkpoint)
    await_all(spark, [fast, slow])
    return fast_out, slow_out, checkpoint


def q_paced_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pacing changes batching, not results: the paced consumer's rows, each with
    its number of copies in the other's."""
    fast_out, slow_out, _ = _consumers(spark, sf_dir)
    out = "junction_id string, zone string, avg_wait_sec double, event_id long"
    copies = (spark.read.schema(out).parquet(fast_out).groupBy("event_id")
              .agg(F.count(F.lit(1)).cast("int").alias("fast_copies")))
    return spark.read.schema(out).parquet(slow_out).join(copies, "event_id", "left")


def q_paced_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paced consumer's backlog: files that each trigger took and left."""
    _, _, checkpoint = _consumers(spark, sf_dir)
    return file_backlog(spark, checkpoint)


# Rows that really come too late: every 40th by this many days, in the files of
# a later slot; the advisory window's own watermark delay.
TOO_LATE_EVERY, TOO_LATE_SLOTS, LATE_ROWS_DELAY = 40, 3, "45 minutes"


def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ward energy over input with rows beyond the watermark, as progress reports
    tell it: rows that came in and rows that were dropped."""
    ev = fx.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    width = SLOT_DAYS * 86_400_000_000
    slot = (F.floor(epoch_micros("ts") / width)
            + F.when(F.col("event_id") % TOO_LATE_EVERY == 0, TOO_LATE_SLOTS).otherwise(0))
    path = scratch_path(spark, "too_late")
    _write_slots(ev, slot, path)
    _arrive_in_order(spark, path)
    stream = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", SLOT_BUCKETS)
              .option("recursiveFileLookup", True).parquet(path))
    agg = ward_energy(_utc(fx.meter_readings(stream)), delay=LATE_ROWS_DELAY)
    name = f"late_rows_{scratch_path(spark, 'x').rsplit('-', 1)[1]}"
    with ProgressLog(spark, scratch_path(spark, "late_progress"), (name,)) as log:
        q = to_parquet(agg, scratch_path(spark, "late_rows"), scratch_path(spark, "late_rows_ckpt"),
                       name=name)
        log.started(q)
        _run(q)
    return log.read().agg(F.sum("input_rows").alias("input_rows"),
                          (F.sum("dropped_late") > 0).alias("some_dropped"))


def q_stream_advisory_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The advisory job with both sinks behind one commit record an epoch: the
    last message of each zone and window, with the table's row beside it."""
    air = _utc(fx.air_quality(event_stream(spark, sf_dir)))
    zones = fx.zone_profile(fx.table(spark, sf_dir, "nation"))
    adv = zone_advisories(air, zones, "10 minutes", "2 minutes", delay="10 minutes")
    adv = (adv.withColumn("window_start", utc_to_ntz("window_start").cast("string"))
              .withColumn("window_end", utc_to_ntz("window_end").cast("string")))
    root = scratch_path(spark, "advisory_sinks")
    _run(fan_out_committed(adv, {"table": parquet_sink, "messages": kv_sink("zone")}, root,
                           scratch_path(spark, "advisory_sinks_ckpt"), "update"))
    manifest = EpochManifest(spark, root)
    kv = manifest.read("messages", "key string, value string", "json")
    told = _last_update(kv.select("epoch", F.from_json("value", adv.schema).alias("d"))
                        .select("epoch", "d.*"), ["zone", "window_start"])
    table = _last_update(manifest.read("table", adv.schema), ["zone", "window_start"])
    return told.join(table.select("zone", "window_start", F.col("rolling_avg_aqi").alias("table_avg")),
                     ["zone", "window_start"], "full").select(*adv.columns, "table_avg")


#: Interval of the periodic summary; buckets that a reason's rows are dealt to.
SUMMARY_MS, SUMMARY_SHARES = 1000, 8


def q_stream_periodic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by error reason, told by a processing-time timer while rows come."""
    air = Q.validate(fx.air_quality(event_stream(spark, sf_dir)), Q.AIR_QUALITY)
    gps = Q.validate(fx.bus_gps(event_stream(spark, sf_dir)), Q.BUS_GPS)
    merged = air.select("error_reason", "event_id").unionByName(gps.select("error_reason", "event_id"))
    path = scratch_path(spark, "periodic")
    q = to_parquet(periodic_counts(merged, SUMMARY_MS, SUMMARY_SHARES), path,
                   scratch_path(spark, "periodic_ckpt"), trigger={"processingTime": "500 milliseconds"})
    total = 2 * fx.table(spark, sf_dir, "events").count()
    told = "error_reason string, share long, told_ms long, records long"

    def last() -> DataFrame:
        try:
            rows = spark.read.schema(told).parquet(path)
        except AnalysisException:  # the sink has not made its folder yet
            rows = spark.createDataFrame([], told)
        return rows.groupBy("error_reason", "share").agg(F.max("records").alias("n"))
    run_until(q, lambda: (last().agg(F.sum("n")).first()[0] or 0) >= total)
    return (last().rollup("error_reason").agg(F.sum("n").alias("records"))
            .select(F.coalesce("error_reason", F.lit("TOTAL_SCANNED")).alias("error_reason"), "records"))


def q_stream_scan_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings scanned and failed and distinct zones, from partials of every
    epoch of a job that is stopped and started again half way."""
    days = scratch_path(spark, "scan_days")
    ev = fx.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    _write_slots(ev.where("event_id % 2 = 0"), F.floor(epoch_micros("ts") / (10 * 86_400_000_000)), days)
    path, checkpoint = scratch_path(spark, "scan_totals"), scratch_path(spark, "scan_totals_ckpt")

    def run() -> None:
        stream = read_stream(spark, "file", path=days, schema=ev.schema, fmt="parquet",
                             recursiveFileLookup=True, maxFilesPerTrigger=2 * SLOT_BUCKETS)
        air = Q.validate(fx.air_quality(stream), Q.AIR_QUALITY)
        _run(count_by_epoch(air, F.regexp_extract("zone", "([0-9]+)$", 1), path, checkpoint))
    run()
    _write_slots(ev.where("event_id % 2 = 1"), F.lit(99), days)
    run()
    return merged_counts(spark, path).select("scanned", "failed", F.col("keys").alias("zones"))


def q_stream_rolling_aqi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10/1-minute rolling means behind a 5-minute watermark, append mode: only
    windows that the watermark has closed."""
    air = _utc(fx.air_quality(event_stream(spark, sf_dir)))
    agg = rolling_aqi(air, "10 minutes", "1 minute", delay="5 minutes")
    out = agg.select(utc_to_ntz("window_start").cast("string").alias("window_start"), "zone",
                     F.round("rolling_avg_aqi", 6).alias("rolling_avg_aqi"), "readings")
    path = scratch_path(spark, "rolling")
    _run(to_parquet(out, path, scratch_path(spark, "rolling_ckpt")))
    return spark.read.schema(out.schema).parquet(path)


STREAM_QUERIES = {
    "q_stream_ward_energy": q_stream_ward_energy,
    "q_stream_advisories": q_stream_advisories,
    "q_stream_gridlock": q_stream_gridlock,
    "q_stream_bunching": q_stream_bunching,
    "q_stream_gridlock_ordered": q_stream_gridlock_ordered,
    "q_stream_bunching_ordered": q_stream_bunching_ordered,
    "q_stream_bunching_state": q_stream_bunching_state,
    "q_stream_scan_totals": q_stream_scan_totals,
    "q_stream_rolling_aqi": q_stream_rolling_aqi,
    "q_paced_stream": q_paced_stream,
    "q_paced_backlog": q_paced_backlog,
    "q_stream_late_rows": q_stream_late_rows,
    "q_stream_advisory_messages": q_stream_advisory_messages,
    "q_stream_periodic_counts": q_stream_periodic_counts,
    "q_stream_error_counts": q_stream_error_counts,
    "q_stream_topic_dead_letters": q_stream_topic_dead_letters,
    "q_stream_advisories_sql": q_stream_advisories_sql,
    "q_stream_ward_messages": q_stream_ward_messages,
}

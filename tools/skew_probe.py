"""Task balance of per-key scans when one key holds a third of all rows.

Derives a skewed signal stream from the driver's ``events`` table (whole
table: every third cycle is reassigned to one junction) and measures rows per
task after the shuffle of (a) a plain per-junction window and (b) the
sliced scan used by ``gridlock``.  AQE partition coalescing is off so the
raw partitioning shows.  Prints one JSON line.
"""
import json
import sys

sys.path.insert(0, ".")
from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from citystream.plans.sequence import SPLIT, slice_seconds, with_slice  # noqa: E402
from citystream.session import get_session  # noqa: E402
from citystream.sources.fixtures import Fixtures, traffic_signals  # noqa: E402


def balance(df):
    # Keep the window's output so the optimizer does not prune it away.
    per = df.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count(F.lit(1)).alias("count"), F.max("_r").alias("_m")).agg(
        F.max("count").alias("max"), F.avg("count").alias("avg"), F.count("*").alias("tasks"),
        F.max("_m").alias("longest_run")).first()
    return {"max_rows_per_task": per["max"], "avg_rows_per_task": round(per["avg"], 1),
            "tasks": per["tasks"]}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    parts = int(sys.argv[2]) if len(sys.argv) > 2 else 64
    spark = get_session("local[8]", parts,
                        extra={"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    ev = Fixtures(spark, sf).events
    sig = traffic_signals(ev).withColumn(
        "junction_id", F.when(F.col("event_id") % 3 == 0, F.lit("J_HOT")).otherwise(F.col("junction_id")))
    hot_share = sig.where("junction_id = 'J_HOT'").count() / sig.count()
    plain = sig.withColumn("_r", F.row_number().over(
        Window.partitionBy("junction_id").orderBy("event_time", "event_id")))
    width = slice_seconds(sig, ["junction_id"], "event_time", target_rows=2000)
    sliced = with_slice(sig, "event_time", width).withColumn("_r", F.row_number().over(
        Window.partitionBy("junction_id", SPLIT).orderBy("event_time", "event_id")))
    print(json.dumps({"rows": sig.count(), "hot_key_share": round(hot_share, 3),
                      "shuffle_partitions": parts, "slice_seconds": width,
                      "plain_window": balance(plain), "sliced_window": balance(sliced)}))


if __name__ == "__main__":
    main()

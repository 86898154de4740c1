"""Counts kept as mergeable partials, one set an epoch.

Each micro-batch adds its own partials: observed totals (taken in the pass that
writes them, no extra job) and, for an exact distinct count, bitmaps of the
keys' numbers, 32,768 to a bucket.  Partials of any epochs merge by adding and by
OR, so totals hold across restarts and are never recounted; an epoch that is
repeated overwrites its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from citystream.operators.quality import observe_scan
from citystream.streaming.sinks import _trigger

PARTIAL = "bucket long, bits binary, scanned long, failed long"


def epoch_partials(validated: DataFrame, number: Column) -> DataFrame:
    """(bucket, bits) of the non-null numbers (from 0) of a batch."""
    n = number.cast("long") + 1
    return (validated.where(number.isNotNull())
            .groupBy(F.bitmap_bucket_number(n).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("bits")))


def count_by_epoch(validated: DataFrame, number: Column, path: str, checkpoint: str,
                   trigger: dict | None = None) -> StreamingQuery:
    """Keep each micro-batch's partials below ``path/epoch=N``."""
    spark = validated.sparkSession

    def each(batch: DataFrame, epoch: int) -> None:
        seen, totals = observe_scan(batch, f"scan_{epoch}")
        folder = f"{path.rstrip('/')}/epoch={epoch}"
        epoch_partials(seen, number).write.mode("overwrite").parquet(f"{folder}/kind=bits")
        got = totals.get
        spark.createDataFrame([(int(got["scanned"]), int(got["failed"]))], "scanned long, failed long") \
            .coalesce(1).write.mode("overwrite").parquet(f"{folder}/kind=totals")
    w = validated.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def merged_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row over all epochs: scanned, failed, distinct numbers."""
    rows = spark.read.schema(PARTIAL + ", epoch long, kind string").parquet(path)
    totals = rows.where("kind = 'totals'").agg(F.sum("scanned").alias("scanned"),
                                               F.sum("failed").alias("failed"))
    distinct = (rows.where("kind = 'bits'").groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("b"))
                .agg(F.coalesce(F.sum(F.bitmap_count("b")), F.lit(0).cast("long")).alias("keys")))
    return totals.join(F.broadcast(distinct))  # one row each

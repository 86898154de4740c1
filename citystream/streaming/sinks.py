"""Streaming sinks: Kafka, Parquet (optionally partitioned), fan-out."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType


def _trigger(w, trigger: dict | None):
    return w.trigger(**trigger) if trigger else w.trigger(availableNow=True)


def to_kafka(kv: DataFrame, topic: str, bootstrap: str, checkpoint: str,
             mode: str = "update", trigger: dict | None = None) -> StreamingQuery:
    """(key, value) rows to a Kafka topic.  At-least-once: consumers should be
    idempotent on (key, window)."""
    w = (kv.writeStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("topic", topic).option("checkpointLocation", checkpoint).outputMode(mode))
    return _trigger(w, trigger).start()


def to_parquet(df: DataFrame, path: str, checkpoint: str, mode: str = "append",
               partition_by: Sequence[str] = (), trigger: dict | None = None,
               name: str | None = None) -> StreamingQuery:
    """Exactly-once file sink (the ``_spark_metadata`` log lists committed
    files).  Append mode on an aggregate needs a watermark.

    With ``partition_by``, rows are first hash-partitioned on those columns,
    so each output folder is written by one task per micro-batch (few large
    files instead of one small file per task and folder).
    """
    if partition_by:
        df = df.repartition(*partition_by)
    w = (df.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode(mode))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    return _trigger(w, trigger).start()


def epoch_writer(path: str, partition_by: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """foreachBatch body writing each micro-batch to ``path/epoch=N``.

    Overwriting the epoch's own folder makes a retried batch idempotent, so
    update-mode output is kept exactly once per epoch.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        w = batch.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{path.rstrip('/')}/epoch={epoch}")
    return write


def kv_json_writer(path: str, key: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch body writing the message-sink shape (key, JSON value of
    all columns) as JSON files under ``path/epoch=N``: what the Kafka sink
    would receive, for deployments or tests without a broker."""
    from citystream.functions.json import to_kv

    def write(batch: DataFrame, epoch: int) -> None:
        to_kv(batch, key).write.mode("overwrite").json(f"{path.rstrip('/')}/epoch={epoch}")
    return write


def await_all(spark, queries: Sequence[StreamingQuery]) -> None:
    """Block until every query has ended, waking on each termination
    (``awaitAnyTermination``); the first failure is raised."""
    pending = list(queries)
    while pending:
        spark.streams.awaitAnyTermination()
        spark.streams.resetTerminated()
        for q in [q for q in pending if not q.isActive]:
            pending.remove(q)
            if q.exception():
                raise RuntimeError(str(q.exception()))


def fan_out(df: DataFrame, writers: Sequence[Callable[[DataFrame, int], None]],
            checkpoint: str, mode: str = "update", trigger: dict | None = None) -> StreamingQuery:
    """One query feeding several sinks: each micro-batch is computed once,
    persisted, handed to every writer, then released (instead of one query
    per sink, each re-reading the source)."""
    def each(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            for wr in writers:
                wr(batch, epoch)
        finally:
            batch.unpersist()
    w = (df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .outputMode(mode))
    return _trigger(w, trigger).start()


class EpochManifest:
    """Several sinks of one query that become visible together.

    Each micro-batch writes every sink to folders of its own attempt, then one
    commit record (written aside, renamed into place) that names them.  Readers
    take only what records name: a batch that was killed between two sinks shows
    in none of them, and a repeated batch that has its record writes nothing.
    """

    def __init__(self, spark, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def writer(self, sinks: dict[str, Callable[[DataFrame, str], None]]):
        """foreachBatch body; ``sinks``: name -> (batch, folder) writer."""
        def write(batch: DataFrame, epoch: int) -> None:
            fs, record = self._fs(f"{self.root}/_commits/{epoch}")
            if fs.exists(record):
                return
            attempt = uuid.uuid4().hex[:12]
            batch.persist()
            try:
                for name, sink in sinks.items():
                    sink(batch, f"{self.root}/{name}/epoch={epoch}/attempt={attempt}")
            finally:
                batch.unpersist()
            _, aside = self._fs(f"{self.root}/_commits/.{epoch}-{attempt}")
            out = fs.create(aside, True)
            out.write(bytearray(json.dumps({"epoch": epoch, "attempt": attempt,
                                            "sinks": sorted(sinks)}).encode()))
            out.close()
            fs.rename(aside, record)
        return write

    def folders(self, name: str) -> DataFrame:
        """(epoch, folder) of the committed batches of one sink."""
        fs, commits = self._fs(f"{self.root}/_commits")
        schema = "epoch long, attempt string, sinks array<string>"
        if not fs.exists(commits):
            return self.spark.createDataFrame([], "epoch long, folder string")
        got = self.spark.read.schema(schema).json(f"{self.root}/_commits")
        return got.select("epoch", F.concat(F.lit(f"{self.root}/{name}/epoch="), "epoch",
                                            F.lit("/attempt="), "attempt").alias("folder"))

    def read(self, name: str, schema, fmt: str = "parquet") -> DataFrame:
        """Committed rows of one sink, with their ``epoch``."""
        of = self.folders(name).select("epoch", F.substring_index("folder", "=", -1).alias("attempt"))
        fs, top = self._fs(f"{self.root}/{name}")
        if not fs.exists(top):
            return self.spark.createDataFrame([], schema).withColumn("epoch", F.lit(0).cast("long"))
        kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        parts = StructType([*kind.fields, StructField("epoch", LongType()),
                            StructField("attempt", StringType())])
        rows = self.spark.read.schema(parts).format(fmt).load(f"{self.root}/{name}")
        return rows.join(F.broadcast(of), ["epoch", "attempt"], "left_semi").drop("attempt")


def fan_out_committed(df: DataFrame, sinks: dict[str, Callable[[DataFrame, str], None]],
                      root: str, checkpoint: str, mode: str = "update",
                      trigger: dict | None = None) -> StreamingQuery:
    """One query feeding several sinks below ``root`` through an ``EpochManifest``."""
    w = (df.writeStream.foreachBatch(EpochManifest(df.sparkSession, root).writer(sinks))
         .option("checkpointLocation", checkpoint).outputMode(mode))
    return _trigger(w, trigger).start()


def parquet_sink(batch: DataFrame, folder: str) -> None:
    batch.write.mode("overwrite").parquet(folder)


def kv_sink(key: str) -> Callable[[DataFrame, str], None]:
    """(key, JSON value) messages as JSON files."""
    from citystream.functions.json import to_kv

    def write(batch: DataFrame, folder: str) -> None:
        to_kv(batch, key).write.mode("overwrite").json(folder)
    return write

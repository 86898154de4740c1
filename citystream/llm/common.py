"""Helpers shared by the training-data operators: shared-folder tables, raw
files on the shared file system, packed-array hashing and connected components.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` to a fresh table in the shared folder, reread it."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of whole texts: Python tasks then take them in small batches."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their
    Python workers can import it wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="citystream-code-"), "citystream_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)


def small_batches(spark: SparkSession) -> None:
    """Bound a Python worker's memory: at most 1,000 texts, 16 MB, in a batch."""
    ship_code(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def trimmed(run):
    """A batch function whose worker gives freed memory back when it is done:
    workers are used again by later stages, and what their allocators keep adds up."""
    def lean(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass
    return lean


def width(spark: SparkSession) -> int:
    """The session's shuffle width."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def file_system(uri: str):
    """(pyarrow file system, path) of a shared-folder URI or plain path."""
    from pyarrow import fs
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri)


class SharedFile:
    """Write-then-rename file on the shared file system: a task that is run
    again, or twice at once, leaves one whole file under the final name."""

    def __init__(self, folder: str, name: str):
        self.fs, root = file_system(folder)
        self.fs.create_dir(root, recursive=True)
        self.final = f"{root}/{name}"
        self.temp = f"{root}/.{name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.temp, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.temp, self.final)


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on a uint64 array."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Smallest reachable id of every node of the undirected ``edges`` (a, b).

    Hash-min with pointer jumping: each round a node takes the smallest label
    among itself and its neighbours, then the label of that label.  Labels are
    partially aggregated before the shuffle, so a hub costs one row per map
    task; each round is a table in the shared folder.  Returns (id, label).
    """
    spark = edges.sparkSession
    both = stored(edges.select("a", "b").union(edges.select("b", "a"))
                  .where("a <> b").distinct(), f"{name}-edges")
    labels = stored(both.groupBy(F.col("a").alias("id"))
                    .agg(F.min("b").alias("m"))
                    .select("id", F.least("id", "m").alias("label")), f"{name}-0")
    round_ = 0
    while True:
        round_ += 1
        near = (both.join(labels.withColumnRenamed("id", "b"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near")))
        step = (labels.join(near, "id")
                .select("id", F.col("label").alias("old"),
                        F.least("label", "near").alias("label")))
        up = labels.select(F.col("id").alias("label"), F.col("label").alias("top"))
        nxt = stored(step.join(up, "label", "left")
                     .select("id", "old", F.least("label", F.coalesce("top", "label"))
                             .alias("label")), f"{name}-{round_}")
        labels = nxt.select("id", "label")
        if nxt.where("old <> label").limit(1).count() == 0:
            return labels

"""Session construction and the shared folder for lineage cuts and sinks."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators assume.  Shuffle width is sized per cluster by the
# caller; AQE coalesces small partitions and splits skewed join partitions at
# run time, and may turn a join into a broadcast join only after it has
# measured the real size of the small side.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "citystream", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    ``master`` is left to spark-submit unless given (tests pass ``local[*]``).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment (a shared file system) and is
    only read here.  Where it is unset (local tests), the context's
    checkpoint folder is used, and only if that is unset too, and the master
    is local, is a fresh one created under the system temp dir (the config
    itself cannot be changed at run time, so ``setCheckpointDir`` is used).
    Without a shared folder a cluster run fails here.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="citystream-ckpt-"))
    return sc.getCheckpointDir()


_CLEANED: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint root, in the folder of
    this application, which is removed when the driver's Python ends."""
    app = f"{checkpoint_root(spark).rstrip('/')}/citystream/{spark.sparkContext.applicationId}"
    if app not in _CLEANED:
        _CLEANED.add(app)
        atexit.register(_remove, spark.sparkContext._jvm,
                        spark.sparkContext._jsc.hadoopConfiguration(), app)
    return f"{app}/{name}-{uuid.uuid4().hex[:12]}"


def _remove(jvm, conf, folder: str) -> None:
    try:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    except Exception:  # the JVM has gone first: the files stay
        pass


def cut(df):
    """Cut lineage: write ``df`` as a table in the shared folder and reread it.

    One job, columns prunable, sizes known to the planner.  If an executor is
    lost, later reads come from the files."""
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Streaming and static readers: Kafka, files, rate; CSV lookups; stored Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, ByteType, DataType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, NullType, ShortType, StructField, StructType)

DEFAULT_BOOTSTRAP = "localhost:9092"


def kafka_options(topics: str | list[str], bootstrap: str = DEFAULT_BOOTSTRAP,
                  starting: str = "latest", max_per_trigger: int | None = None,
                  min_partitions: int | None = None, **extra) -> dict[str, str]:
    """Options of a Kafka source subscribed to one or several topics.

    Consumer progress lives in the query checkpoint (offset log), not in a
    consumer group.  ``max_per_trigger`` paces a slow consumer;
    ``min_partitions`` splits topic partitions into more Spark tasks.
    """
    opts = {"kafka.bootstrap.servers": bootstrap,
            "subscribe": topics if isinstance(topics, str) else ",".join(topics),
            "startingOffsets": starting}
    if max_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_stream(spark: SparkSession, kind: str, path: str | None = None,
                schema: StructType | str | None = None, fmt: str = "parquet",
                **opts) -> DataFrame:
    """Streaming source factory: ``kafka`` (options from ``kafka_options``),
    ``file`` (``fmt`` files under ``path``, explicit ``schema``) or ``rate``.

    Kafka rows come out as (key, value) strings plus topic/partition/offset/
    timestamp, so one parse step serves every topic.
    """
    if kind == "kafka":
        raw = spark.readStream.format("kafka").options(**opts).load()
        return raw.select(F.col("key").cast("string").alias("key"),
                          F.col("value").cast("string").alias("value"),
                          "topic", "partition", "offset", "timestamp")
    if kind == "file":
        r = spark.readStream.format(fmt).options(**{k: str(v) for k, v in opts.items()})
        if schema is not None:
            r = r.schema(schema)
        return r.load(path)
    if kind == "rate":
        return spark.readStream.format("rate").options(**{k: str(v) for k, v in opts.items()}).load()
    raise ValueError(f"unknown stream kind: {kind}")


def read_static_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Header CSV with a declared schema (no inference pass, no type drift)."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_lookup_csv(spark: SparkSession, path: str, schema: StructType, key: str) -> DataFrame:
    """CSV lookup with one row per key; a later duplicate of a key wins.

    Order is that of file names, of blocks in a file and of rows in a block
    (row numbers grow within a block, wherever it is read), so it holds for
    several files, and for files read in several splits.
    """
    from citystream.operators.enrich import last_per_key
    df = read_static_csv(spark, path, schema)
    ordered = df.withColumn("_ord", F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id()))
    return last_per_key(ordered, key, "_ord")


def read_stored_parquet(spark: SparkSession, path: str,
                        schema: StructType | str) -> DataFrame:
    """All Parquet files below ``path`` (any depth) as one frame of ``schema``.

    Files are those named ``*.parquet``; a folder without any is read by its
    ``part-*`` files (writers that leave the suffix out).  A missing or empty
    folder gives an empty frame of the schema.  Columns that some files lack
    come back null.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    pattern = None
    if fs.exists(folder):
        files = fs.listFiles(folder, True)
        while files.hasNext():
            name = files.next().getPath().getName()
            if name.endswith(".parquet"):
                pattern = "*.parquet"
                break
            if name.startswith("part-"):
                pattern = "part-*"
    if pattern is None:
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern).parquet(path))


def _wider(a: DataType, b: DataType) -> DataType | None:
    """The type that both are read as without loss, if Parquet readers have one."""
    if a == b:
        return a
    if isinstance(a, NullType) or isinstance(b, NullType):
        return b if isinstance(a, NullType) else a
    for chain in ((ByteType, ShortType, IntegerType, LongType), (FloatType, DoubleType),
                  (ByteType, ShortType, IntegerType, DoubleType)):
        if type(a) in chain and type(b) in chain:
            return max((a, b), key=lambda t: chain.index(type(t)))
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    if isinstance(a, StructType) and isinstance(b, StructType):
        return union_schema([a, b])
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        item = _wider(a.elementType, b.elementType)
        return ArrayType(item, True) if item is not None else None
    return None


def union_schema(schemas: list[StructType]) -> StructType:
    """All columns of the schemas in order of first sight, each in the widest of
    its types; columns without a common type are an error that names them."""
    types: dict[str, DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            had = types.get(f.name)
            new = f.dataType if had is None else _wider(had, f.dataType)
            if new is None:
                raise ValueError(f"column {f.name}: {had.simpleString()} and "
                                 f"{f.dataType.simpleString()} have no common type")
            types[f.name] = new
    return StructType([StructField(n, t, True) for n, t in types.items()])


def reconciled_schema(spark: SparkSession, paths: list[str]) -> StructType:
    """Schema of Parquet files whose columns differ and whose types grew.

    Footers are merged by Spark, in parallel.  Where that fails on a type, the
    list is halved: files in order of age hold few generations, so few reads
    are needed, and only their schemas meet here."""
    try:
        return spark.read.option("mergeSchema", True).parquet(*paths).schema
    except Exception as exc:
        if len(paths) == 1 or "MERGE" not in str(exc):
            raise
    half = len(paths) // 2
    return union_schema([reconciled_schema(spark, paths[:half]), reconciled_schema(spark, paths[half:])])


def stored_files(spark: SparkSession, path: str) -> list[str]:
    """Data files below ``path`` in order of age: ``*.parquet``, else ``part-*``."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    if fs.exists(folder):
        files = fs.listFiles(folder, True)
        while files.hasNext():
            f = files.next()
            name = f.getPath().getName()
            if name.endswith(".parquet") or (name.startswith("part-") and not name.endswith(".crc")):
                found.append((f.getModificationTime(), f.getPath().toString(), name))
    named = [x for x in found if x[2].endswith(".parquet")]
    return [p for _, p, _ in sorted(named or found)]


def read_generations(spark: SparkSession, path: str) -> DataFrame | None:
    """All stored files below ``path`` as one frame whose schema is reconciled
    over them: missing columns are null, grown types are read as the widest.
    None if there is no file."""
    files = stored_files(spark, path)
    if not files:
        return None
    schema = reconciled_schema(spark, files)
    return spark.read.schema(schema).parquet(*files)

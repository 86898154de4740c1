"""Token-ID / binary output with a minimal perfect hash index.

File format, below one folder of the shared file system:

* ``shard-NNNNN.bin`` -- raw little-endian ids (unsigned 16 bit where the
  vocabulary fits, else 32 bit), documents in ascending key order, each with
  the end id behind it.  Shards are key ranges, so shard order is key order.
* ``index/`` -- Parquet, one row per index bucket: the bit arrays of a minimal
  perfect hash over the bucket's document keys and, slot by slot, a 32-bit
  fingerprint of the key, shard, first id in the shard and number of ids.

A key is found in constant time: hash -> bucket -> rank of its bit -> slot;
the stored fingerprint rejects keys that were never written (but one in 2^32).
Buckets are sized by count, so the index grows with the data and no task
holds more than a bucket.

Key: (doc_id, occurrence); rows that repeat a doc_id are occurrences 0, 1, ...
in the order of their ids, a null doc_id sorts first, null text is empty (just
the end id).  An empty table gives no shards and no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.llm import bpe
from citystream.llm.common import (SharedFile, file_system, mix64, read, stored,
                                   width)
from citystream.session import scratch_path

#: Keys per index bucket (mean).
BUCKET_KEYS = 20_000
#: Bits per key on a level of the perfect hash.
GAMMA = 2
NULL_KEY = -(2 ** 63) + 11


# ---- minimal perfect hash of one bucket -----------------------------------

def key_hash(doc_id: np.ndarray, occ: np.ndarray) -> np.ndarray:
    return mix64(mix64(doc_id.astype(np.int64).view(np.uint64))
                 + occ.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _slot(h: np.ndarray, level: int, bits: int) -> np.ndarray:
    return (mix64(h + np.uint64((level + 1) * 0xD6E8FEB86659FD93 % 2 ** 64))
            % np.uint64(bits)).astype(np.int64)


def mph_build(h: np.ndarray) -> list[bytes]:
    """Levels of bits: keys that are alone on their bit stay, the rest go on."""
    levels: list[bytes] = []
    while len(h):
        bits = max(64, -(-len(h) * GAMMA // 8) * 8)
        at = _slot(h, len(levels), bits)
        alone = np.bincount(at, minlength=bits)[at] == 1
        mask = np.zeros(bits, np.uint8)
        mask[at[alone]] = 1
        levels.append(np.packbits(mask).tobytes())
        h = h[~alone]
    return levels


def mph_find(levels: list[bytes], h: np.ndarray) -> np.ndarray:
    """Slot of each key (-1: surely not a key)."""
    out = np.full(len(h), -1, np.int64)
    left, before = np.arange(len(h)), 0
    for i, raw in enumerate(levels):
        mask = np.unpackbits(np.frombuffer(raw, np.uint8))
        rank = np.cumsum(mask) - mask + before
        at = _slot(h[left], i, len(mask))
        hit = mask[at] == 1
        out[left[hit]] = rank[at[hit]]
        left, before = left[~hit], before + int(mask.sum())
    return out


# ---- writing --------------------------------------------------------------

def _encoder(tokenizer: str, end_id: int, bounds: list[int], dtype: str):
    cuts = np.array(bounds, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tab = bpe.table(tokenizer)
        for b in batches:
            docs = b.column(0)
            texts = b.column(1).fill_null("")
            for lo, hi in bpe.slices(texts):
                ids, n = tab.encode(texts[lo:hi])
                ids = np.insert(ids, np.cumsum(n), end_id).astype(dtype)
                ends = np.cumsum(n + 1)
                raw = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), hi - lo,
                    [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)
                                        * ids.itemsize), pa.py_buffer(ids)])
                key = docs.slice(lo, hi - lo)
                at = np.searchsorted(cuts, key.fill_null(-2 ** 63).to_numpy(), "right")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at.astype(np.int32)), key, raw.cast(pa.binary())],
                    ["shard", "doc_id", "ids"])
    return run


def _shard_writer(folder: str, itemsize: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, shard, at, last, occ = None, None, 0, object(), 0
        for b in batches:
            rows: list[tuple] = []
            for s, d, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                 b.column(2)):
                if s != shard:
                    if out:
                        out.close()
                    out, shard, at, last = SharedFile(folder, f"shard-{s:05d}.bin"), s, 0, object()
                occ = occ + 1 if d == last else 0
                last = d
                data = raw.as_buffer()
                n = data.size // itemsize
                out.write(data)
                rows.append((d, occ, s, at, n))
                at += n
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(),
                                                       pa.int64(), pa.int64()))],
                ["doc_id", "occ", "shard", "at", "n"])
        if out:
            out.close()
    return run


def _index_builder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by bucket: one row of packed arrays per bucket."""
    def flush(bucket, parts):
        d, occ, s, at, n = (np.concatenate(x) for x in zip(*parts))
        h = key_hash(d, occ)
        levels = mph_build(h)
        order = np.argsort(mph_find(levels, h))
        pack = [(h >> np.uint64(32)).astype("<u4"), s.astype("<u4"), at.astype("<u8"),
                n.astype("<u8")]
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket], pa.int32()), pa.array([levels], pa.list_(pa.binary()))]
            + [pa.array([x[order].tobytes()], pa.binary()) for x in pack],
            ["bucket", "levels", "prints", "shards", "ats", "ns"])

    bucket, parts = None, []
    for b in batches:
        at = b.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
        cols = [b.column(i).to_numpy() for i in range(1, 6)]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            if bucket is not None and at[lo] != bucket:
                yield flush(bucket, parts)
                parts = []
            bucket = int(at[lo])
            parts.append([c[lo:hi] for c in cols])
    if parts:
        yield flush(bucket, parts)


def _key(name: str):
    """doc_id as a key: null is a key of its own."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_KEY))


def _bucket(n: int):
    def run(doc_id, occ):
        import pandas as pd
        h = key_hash(doc_id.to_numpy(), occ.to_numpy())
        return pd.Series((mix64(h) % np.uint64(n)).astype(np.int32))
    import pandas as pd
    run.__annotations__ = {"doc_id": pd.Series, "occ": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "int")


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0,
                 shards: int | None = None) -> dict:
    """Encode ``docs`` (doc_id, text; other columns are not read) into
    ``folder``; returns the description that the readers take."""
    spark = docs.sparkSession
    dtype = "<u2" if bpe.load(tokenizer).get_vocab_size() <= 2 ** 16 else "<u4"
    shards = shards or width(spark)
    keys = docs.select(F.col("doc_id").cast("long"))
    bounds = (keys.approxQuantile("doc_id", [i / shards for i in range(1, shards)], 0.1 / shards)
              if shards > 1 else [])
    bounds = sorted({int(x) for x in bounds})
    ids = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
           .mapInArrow(_encoder(tokenizer, end_id, bounds, dtype),
                       "shard int, doc_id long, ids binary"))
    n = len(bounds) + 1
    entries = (ids.repartitionById(n, F.col("shard"))
               .sortWithinPartitions("shard", "doc_id", "ids")
               .mapInArrow(_shard_writer(folder, np.dtype(dtype).itemsize),
                           "doc_id long, occ int, shard int, at long, n long"))
    entries = stored(entries, "token-entries")
    buckets = max(1, -(-entries.count() // BUCKET_KEYS))
    (entries.withColumn("doc_id", _key("doc_id"))
     .withColumn("bucket", _bucket(buckets)("doc_id", "occ"))
     .select("bucket", "doc_id", "occ", "shard", "at", "n")
     .repartition(min(buckets, 4 * width(spark)), "bucket").sortWithinPartitions("bucket")
     .mapInArrow(_index_builder, "bucket int, levels array<binary>, prints binary, "
                                 "shards binary, ats binary, ns binary")
     .write.parquet(f"{folder}/index"))
    return {"folder": folder, "buckets": buckets, "dtype": dtype, "entries": entries}


# ---- reading --------------------------------------------------------------

def _find(left, right):
    """Cogrouped by bucket: keys against the bucket's index row."""
    import pandas as pd
    out = {"doc_id": [], "occ": [], "shard": [], "at": [], "n": []}
    if len(left) and len(right):
        r = right.iloc[0]
        prints = np.frombuffer(r["prints"], "<u4")
        h = key_hash(left["doc_id"].to_numpy(), left["occ"].to_numpy())
        slot = mph_find(list(r["levels"]), h)
        ok = slot >= 0
        ok[ok] = prints[slot[ok]] == (h[ok] >> np.uint64(32)).astype("<u4")
        got = slot[ok]
        out = {"doc_id": left["doc_id"][ok].to_numpy(), "occ": left["occ"][ok].to_numpy(),
               "shard": np.frombuffer(r["shards"], "<u4")[got].astype(np.int32),
               "at": np.frombuffer(r["ats"], "<u8")[got].astype(np.int64),
               "n": np.frombuffer(r["ns"], "<u8")[got].astype(np.int64)}
    return pd.DataFrame(out).astype({"occ": "int32", "shard": "int32"})


def find_tokens(spark: SparkSession, about: dict, keys: DataFrame) -> DataFrame:
    """Entries (doc_id, occ, shard, at, n) of ``keys`` (doc_id, occ); keys that
    were never written have none."""
    keys = (keys.select(_key("doc_id").alias("doc_id"), F.col("occ").cast("int"))
            .withColumn("bucket", _bucket(about["buckets"])("doc_id", "occ")))
    index = spark.read.parquet(f"{about['folder']}/index")
    return (keys.groupBy("bucket").cogroup(index.groupBy("bucket"))
            .applyInPandas(_find, "doc_id long, occ int, shard int, at long, n long")
            .withColumn("doc_id", F.when(F.col("doc_id") != NULL_KEY, F.col("doc_id"))))


def _ranges(folder: str, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        shard, src = None, None
        size = np.dtype(dtype).itemsize
        for b in batches:
            payload = []
            for s, at, n in zip(*(b.column(i).to_pylist() for i in (2, 3, 4))):
                if s != shard:
                    if src:
                        src.close()
                    shard, src = s, fs.open_input_file(f"{root}/shard-{s:05d}.bin")
                payload.append(src.read_at(n * size, at * size))
                if sum(map(len, payload[-1:])) == 0 and n:
                    raise OSError(f"shard {s} ends before id {at}")
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(payload, pa.binary())],
                [*b.schema.names, "ids"])
        if src:
            src.close()
    return run


def read_tokens(spark: SparkSession, about: dict, entries: DataFrame) -> DataFrame:
    """Add the raw ids (binary, ``about['dtype']``) of each entry, by ranged
    reads in file order."""
    return (entries.select("doc_id", "occ", "shard", "at", "n")
            .repartitionByRange(width(spark), "shard", "at")
            .sortWithinPartitions("shard", "at")
            .mapInArrow(_ranges(about["folder"], about["dtype"]),
                        "doc_id long, occ int, shard int, at long, n long, ids binary"))


def _digest(dtype: str):
    def run(ids):
        import pandas as pd
        return pd.Series([zlib.crc32(np.frombuffer(x, dtype).astype("<u4").tobytes())
                          for x in ids], dtype="int64")
    import pandas as pd
    run.__annotations__ = {"ids": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "long")


def op2_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents' ids, look every key up in the index, read back."""
    import public_tokenizers
    docs = read(spark, sf_dir, "documents")
    about = write_tokens(docs, scratch_path(spark, "llm-tokens"),
                         public_tokenizers.path("byte_bpe_50k.json"))
    entries = about["entries"]
    found = find_tokens(spark, about, entries.select("doc_id", "occ"))
    back = read_tokens(spark, about, found)
    # Ids before each shard: a running sum over one row per shard.
    from pyspark.sql import Window
    before = (entries.groupBy("shard").agg(F.sum("n").alias("m"))
              .select("shard", (F.sum("m").over(Window.orderBy("shard")) - F.col("m"))
                      .alias("before")))
    return (back.join(before, "shard")
            .select("doc_id", (F.col("before") + F.col("at")).alias("start"),
                    F.col("n").alias("n_tokens"),
                    _digest(about["dtype"])("ids").alias("ids_crc32")))

"""Exact top-k inner-product search with a pivot-distance index.

Vectors become integers (floor(64 x)).  A vector v gets one more coordinate
sqrt(M - |v|^2), with M the largest squared norm, a query q gets 0: then
|q - v|^2 = |q|^2 + M - 2 <q, v>, so the largest products are the nearest
points and the triangle inequality applies.

Index: each vector is keyed by its nearest pivot and its distance to it.  The
keys are range-partitioned and packed, in key order, into cells (annuli) of at
most ``CELL`` vectors; ties are dealt out by vec_id, so a vector that a third
of all rows share fills many cells, not one.  Search: blocks of queries first
visit the few annuli nearest to them; the k-th score found so far gives each
query a radius.  The annuli are then expanded: of all others, those whose
distance range [lo, hi] meets |d(query, pivot) - r| <= radius for some query
of the block; the rest cannot hold a better vector and are never read.  Only
scores that reach the query's k-th score so far leave a visit.

Pivots are fitted on a bounded sample (``SAMPLE`` rows by hash of vec_id); the
index holds every row, and results are exact whatever the pivots are.

Components and norms are doubles, which hold them exactly; products are summed as
doubles, 64-bit or Python integers, by size.  A score outside 64 bits leaves as
the nearest long, and counts as that in the order.

Defined results: null vectors and vectors with null or non-finite components
take no part, neither do null ids; shorter vectors are padded with zeros; rows
that repeat a vec_id count once (the smallest vector); ties go to the smaller
vec_id; fewer than k candidates give all of them; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citystream.llm.common import read, small_batches, stored, width

SCALE = 64
#: Components beyond this count as this: their scores are outside 64 bits anyway.
LARGEST = 1e140
CELL = 2048
QUERY_BLOCK = 256
#: Score of a k-th result that is not known yet.
NONE = -(2 ** 63)
#: Rows that pivots are fitted on; most pivots; annuli of the first visit.
SAMPLE, PIVOTS, FIRST = 4096, 64, 3


def _fit_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-point pivots moved to the means of their neighbours."""
    picked = [0]
    d = ((sample - sample[0]) ** 2).sum(1)
    while len(picked) < min(count, len(sample)) and d.max() > 0:
        picked.append(int(d.argmax()))
        d = np.minimum(d, ((sample - sample[picked[-1]]) ** 2).sum(1))
    p = sample[picked]
    for _ in range(4):
        near = _distances(sample, p).argmin(1)
        p = np.array([sample[near == i].mean(0) if (near == i).any() else p[i]
                      for i in range(len(p))])
    return p


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    sq = (x ** 2).sum(1)[:, None] + (p ** 2).sum(1)[None, :] - 2 * x @ p.T
    return np.sqrt(np.maximum(sq, 0))


def _augment(v: np.ndarray, most: float) -> np.ndarray:
    return np.hstack([v, np.sqrt(np.maximum(most - (v ** 2).sum(1), 0))[:, None]])


def _floor(e):
    """floor(64 e) as a double: from 2^53 on a double is a whole number."""
    y = F.greatest(F.least(e, F.lit(LARGEST)), F.lit(-LARGEST)) * SCALE
    return F.when(F.abs(y) < 2.0 ** 53, F.floor(y).cast("double")).otherwise(y)


def integer_vectors(table: DataFrame, id_col: str = "vec_id",
                    vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>, norm2) of the rows that take part."""
    x = F.transform(F.col(vec_col), lambda e: e.cast("double"))
    fine = F.forall(F.col("x"), lambda e: e.isNotNull() & ~F.isnan(e)
                    & (F.abs(e) < F.lit(float("inf"))))
    return (table.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
            .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & fine)
            .select("vec_id", F.transform("x", _floor).alias("v"))
            .groupBy("vec_id").agg(F.min("v").alias("v"))
            .withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, e: a + e * e)))


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    out = np.zeros((len(col), dim))
    n = col.value_lengths().to_numpy()
    flat = col.flatten().to_numpy()
    rows = np.repeat(np.arange(len(col)), n)
    pos = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
    out[rows, pos] = flat
    return out


def _keyer(pivots, most: float, dim: int):
    """vec_id, v -> pivot, distance of the point and of the query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pivots.value
        for b in batches:
            v = _matrix(b.column(1), dim)
            d = _distances(_augment(v, most), p)
            near = d.argmin(1)
            dq = _distances(np.hstack([v, np.zeros((len(v), 1))]), p)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(v)), near]),
                 pa.array(dq.argmin(1).astype(np.int32)), pa.array(dq.min(1)),
                 pa.array([x.tobytes() for x in v.astype("<f8")], pa.binary())],
                ["vec_id", "pivot", "r", "qpivot", "qr", "v"])
    return run


def _packer(size: int):
    """Rows (vec_id, pivot, r, v) in key order -> cells of one pivot."""
    def pack(part):
        ids, pivot, r, v = (np.concatenate(x) if i < 3 else sum(x, [])
                            for i, x in enumerate(zip(*part)))
        return pa.RecordBatch.from_arrays(
            [pa.array([int(ids.min())]), pa.array([int(pivot[0])], pa.int32()),
             pa.array([float(r.min())]), pa.array([float(r.max())]), pa.array([len(ids)]),
             pa.array([ids.astype("<i8").tobytes()], pa.binary()),
             pa.array([b"".join(v)], pa.binary())],
            ["cell", "pivot", "lo", "hi", "n", "ids", "vs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, have, last = [], 0, None
        for b in batches:
            ids, pivot, r = (b.column(i).to_numpy() for i in range(3))
            v = b.column(3).to_pylist()
            lo = 0
            while lo < len(ids):
                if have and (have == size or pivot[lo] != last):
                    yield pack(part)
                    part, have = [], 0
                last = pivot[lo]
                same = np.flatnonzero(pivot[lo:lo + size - have] != last)
                hi = lo + (int(same[0]) if len(same) else min(size - have, len(ids) - lo))
                part.append((ids[lo:hi], pivot[lo:hi], r[lo:hi], v[lo:hi]))
                have += hi - lo
                lo = hi
        if have:
            yield pack(part)
    return run


_CELL = "cell long, pivot int, lo double, hi double, n long, ids binary, vs binary"


def _reach(pivots, most: float, dim: int, first: bool):
    """Query blocks -> (block, pivot, near, far): distances at which the annuli
    of each pivot may hold results; ``taus`` is each query's k-th score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pivots.value
        for b in batches:
            for cell, vs, taus in zip(*(b.column(i).to_pylist() for i in range(3))):
                q = np.frombuffer(vs, "<f8").reshape(-1, dim)
                d = _distances(np.hstack([q, np.zeros((len(q), 1))]), p)
                if first:
                    lo = hi = d.mean(0)
                else:
                    tau = np.frombuffer(taus, "<i8").reshape(-1, 2)[:, 0]
                    all_ = (q ** 2).sum(1) + most
                    radius = np.where(tau > NONE, np.sqrt(np.maximum(all_ - 2.0 * tau, 0)), np.inf)
                    # Slack for rounding: a larger radius only visits more.
                    radius = radius + 1e-6 * np.sqrt(all_) + 1e-3
                    lo = (d - radius[:, None]).min(0)
                    hi = (d + radius[:, None]).max(0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cell] * len(p)), pa.array(np.arange(len(p), dtype=np.int32)),
                     pa.array(lo), pa.array(hi)], ["block", "pivot", "near", "far"])
    return run


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers of any size, held to 64 bits."""
    x, y = (np.array([[int(e) for e in row] for row in m], object).reshape(m.shape) for m in (q, c))
    most = 2 ** 63 - 1
    return np.array([[max(-most, min(most, int(v))) for v in row] for row in x @ y.T],
                    np.int64).reshape(len(q), len(c))


def _visit(k: int, dim: int):
    """(ids, vs) of a query block with (ids, vs) of a cell -> its best products
    that come before the query's k-th result so far, at most k a query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for qi, qv, taus, ci, cv in zip(*(b.column(i) for i in range(5))):
                qid = np.frombuffer(qi.as_buffer(), "<i8")
                cid = np.frombuffer(ci.as_buffer(), "<i8")
                tau, last = np.frombuffer(taus.as_buffer(), "<i8").reshape(-1, 2).T
                q = np.frombuffer(qv.as_buffer(), "<f8").reshape(-1, dim)
                c = np.frombuffer(cv.as_buffer(), "<f8").reshape(-1, dim)
                order = np.argsort(cid, kind="stable")  # ties: smaller vec_id first
                cid, c = cid[order], c[order]
                big = np.abs(q).max(initial=0) * 1.0 * np.abs(c).max(initial=0) * dim
                if big < 2.0 ** 52:
                    s = (q @ c.T).astype(np.int64)
                elif big < 2.0 ** 62:
                    s = q.astype(np.int64) @ c.astype(np.int64).T
                else:
                    s = _products(q, c)
                take = (s > tau[:, None]) | ((s == tau[:, None]) & (cid[None, :] < last[:, None]))
                take &= qid[:, None] != cid[None, :]
                rows, cols, vals = [], [], []
                for i in np.flatnonzero(take.any(1)):
                    j = np.flatnonzero(take[i])
                    if len(j) > k:
                        j = j[np.argsort(-s[i, j], kind="stable")[:k]]
                    rows.append(np.full(len(j), qid[i]))
                    cols.append(cid[j])
                    vals.append(s[i, j])
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x)) for x in (rows, cols, vals)],
                        ["query_id", "vec_id", "score"])
    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _with_taus(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """block, ids, vs, [(query id, score, vec_id of its k-th result)] -> block, ids,
    vs, taus: (score, vec_id) in id order."""
    for b in batches:
        out = []
        for ids, kth in zip(b.column(1), b.column(3)):
            own = np.frombuffer(ids.as_buffer(), "<i8")
            at = {x["query_id"]: (x["score"], x["vec_id"]) for x in kth.as_py() or []}
            tau = [at.get(int(x), (NONE, NONE)) for x in own]
            out.append(np.array(tau, "<i8").tobytes())
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out, pa.binary())],
                                         ["block", "ids", "vs", "taus"])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """``vectors`` as of ``integer_vectors``; ``queries`` (vec_id) names the
    rows that ask.  -> query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    small_batches(spark)
    result = "query_id long, rank int, vec_id long, score long"
    vectors = stored(vectors, "vectors")
    size = vectors.agg(F.count("*").alias("n"), F.max("norm2").alias("m"),
                       F.max(F.size("v")).alias("d")).first()
    if not size["n"]:
        return spark.createDataFrame([], result)
    dim, most = max(1, size["d"]), float(size["m"])
    part = min(1.0, SAMPLE / size["n"])
    sample = (vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(part * (1 << 20)) + 1)
              .orderBy(F.xxhash64("vec_id")).limit(SAMPLE).select("v").toArrow())
    v = sample.column("v").combine_chunks()
    v = v.chunk(0) if isinstance(v, pa.ChunkedArray) else v
    count = int(max(4, min(PIVOTS, size["n"] ** 0.5 / 4)))
    pivots = spark.sparkContext.broadcast(_fit_pivots(_augment(_matrix(v, dim), most), count))

    keyed = stored(vectors.select("vec_id", "v").mapInArrow(
        _keyer(pivots, most, dim),
        "vec_id long, pivot int, r double, qpivot int, qr double, v binary"), "keys")
    n = width(spark)
    cells = stored(keyed.select("vec_id", "pivot", "r", "v")
                   .repartitionByRange(n, "pivot", "r", "vec_id")
                   # Full cells, however many partitions the session deals rows to.
                   .coalesce(max(1, -(-size["n"] // (4 * CELL))))
                   .sortWithinPartitions("pivot", "r", "vec_id")
                   .mapInArrow(_packer(CELL), _CELL), "cells")
    asked = keyed.join(queries.select("vec_id").distinct(), "vec_id", "left_semi")
    blocks = stored(asked.select("vec_id", F.col("qpivot").alias("pivot"),
                                 F.col("qr").alias("r"), "v")
                    .repartitionByRange(n, "pivot", "r", "vec_id")
                    .sortWithinPartitions("pivot", "r", "vec_id")
                    .mapInArrow(_packer(QUERY_BLOCK), _CELL)
                    .select(F.col("cell").alias("block"), "ids", "vs"), "query-blocks")
    annuli = cells.select("cell", "pivot", "lo", "hi", "n")
    none = blocks.withColumn("taus", F.lit(None).cast("binary"))
    reach = "block long, pivot int, near double, far double"

    # First visit: the annuli whose distance range is closest to the block's.
    gap = F.greatest(F.col("lo") - F.col("near"), F.col("near") - F.col("hi"), F.lit(0.0))
    close = Window.partitionBy("block").orderBy("bound", "cell")
    start = stored(
        none.select("block", "vs", "taus").mapInArrow(_reach(pivots, most, dim, True), reach)
        .join(annuli, "pivot").withColumn("bound", gap + F.lit(1e-3) * F.col("near"))
        .withColumn("i", F.row_number().over(close)).where(F.col("i") <= FIRST)
        .select("block", "cell"), "first-visits")

    def visit(pairs: DataFrame, asking: DataFrame) -> DataFrame:
        c = cells.select("cell", F.col("ids").alias("cids"), F.col("vs").alias("cvs"))
        return (pairs.join(asking, "block").join(c, "cell")
                .select("ids", "vs", "taus", "cids", "cvs")
                .mapInArrow(_visit(k, dim), "query_id long, vec_id long, score long"))

    def with_taus(found: DataFrame | None) -> DataFrame:
        if found is None:
            known = blocks.select("block", "ids", "vs", F.lit(None).cast(
                "array<struct<query_id:bigint,score:bigint,vec_id:bigint>>").alias("kth"))
        else:
            kth = _best(found, k).where(F.col("rank") == k).select("query_id", "score", "vec_id")
            home = blocks.select("block", "ids").mapInArrow(_unpack, "block long, query_id long")
            per = (home.join(kth, "query_id").groupBy("block")
                   .agg(F.collect_list(F.struct("query_id", "score", "vec_id")).alias("kth")))
            known = blocks.join(per, "block", "left").select("block", "ids", "vs", "kth")
        return known.mapInArrow(_with_taus, "block long, ids binary, vs binary, taus binary")

    found = stored(_best(visit(start, with_taus(None)), k).drop("rank"), "first-found")
    asking = stored(with_taus(found), "asking")
    more = (asking.select("block", "vs", "taus")
            .mapInArrow(_reach(pivots, most, dim, False), reach)
            .join(annuli, "pivot").where((F.col("hi") >= F.col("near")) & (F.col("lo") <= F.col("far")))
            .select("block", "cell").join(start, ["block", "cell"], "left_anti"))
    rest = visit(more, asking)
    return _best(found.unionByName(rest), k).select("query_id", "rank", "vec_id", "score")


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """block, ids -> one row (block, query_id) for each id."""
    for b in batches:
        for block, ids in zip(b.column(0).to_pylist(), b.column(1)):
            own = np.frombuffer(ids.as_buffer(), "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), block)), pa.array(own)],
                                             ["block", "query_id"])


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(read(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.select("vec_id").where("vec_id % 20 = 0"), 20)


#: DuckDB twin of the query.
TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank,
         vec_id, score FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""

"""Hard-negative mining with Four-Russians scoring.

Components become integers (floor(256 x)).  Candidates are stored as packed
bit planes: for each bit of the two's complement and each group of eight
dimensions one byte.  An anchor has, for each group, a table of the 256 subset
sums of its eight components.  The inner product is then lookups and shifts
only: from the highest plane down, score = 2 * score + sum over groups of
table[byte], with the sign plane subtracted.  Every score is full and exact.

Both sides are packed into bounded cells (``CELL`` candidates, ``BLOCK``
anchors, in order of label and id, so a label that holds a third of all rows
fills many cells).  The first pass meets cells that share a label with an
anchor block and keeps each anchor's best rows of its own label; the second
meets all cells and keeps, for each anchor and positive, the best rows of other
labels inside the score window.  A visit of a block and a cell gives at most
``positives`` (x ``negatives``) rows an anchor, whatever ties or repeated
vectors there are; Spark ranks what is left.

Defined results: rows with a null id, label or vector, or with null or
non-finite components take no part; shorter vectors are padded with zeros; rows
that repeat an id count once (the smallest label and vector); ties go to the
smaller id; an anchor without a positive, or a positive without a row in its
window, gives no row; an empty table gives none.  Scores beyond 64 bits are
compared exactly up to 38 digits and leave as the nearest long.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citystream.llm.common import read, small_batches, stored, width

SCALE = 256
CELL, BLOCK = 2048, 256
#: Anchors scored at once: their tables stay in the processor's cache.
STRIPE = 32
GROUP = 8
_MOST, _LEAST = Decimal(10 ** 38 - 1), Decimal(-(10 ** 38 - 1))


def labelled_vectors(table: DataFrame, label: str | Column = "label", id_col: str = "vec_id",
                     vec_col: str = "embedding") -> DataFrame:
    """(vec_id, label, x array<double>) of the rows that take part."""
    label = F.col(label) if isinstance(label, str) else label
    fine = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return (table.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                         F.transform(vec_col, lambda e: e.cast("double")).alias("x"))
            .where("vec_id is not null and label is not null and x is not null").where(fine)
            .groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("r"))
            .select("vec_id", "r.label", "r.x"))


def integers(col: pa.Array, dim: int) -> np.ndarray:
    """Rows of doubles -> floor(256 x), as int64 or, if large, Python integers."""
    x = np.zeros((len(col), dim))
    n = col.value_lengths().to_numpy()
    flat = col.flatten().to_numpy()
    rows = np.repeat(np.arange(len(col)), n)
    x[rows, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    if np.abs(x).max(initial=0) < 2.0 ** 44:
        return np.floor(x * SCALE).astype(np.int64)
    # From 2^53 on a double is an integer; the product could leave its range.
    out = [int(e) * SCALE if abs(e) >= 2.0 ** 53 else int(np.floor(e * SCALE)) for e in x.ravel()]
    return np.array(out, object).reshape(x.shape)


def bit_planes(v: np.ndarray) -> np.ndarray:
    """(planes, groups, rows) bytes: bit b of eight neighbouring components."""
    n, dim = v.shape
    groups = max(1, -(-dim // GROUP))
    top = max((int(v.max()).bit_length(), int(v.min()).bit_length())) if v.size else 0
    wide = np.zeros((n, groups * GROUP), v.dtype)
    wide[:, :dim] = v
    out = np.empty((top + 1, groups, n), np.uint8)
    for b in range(top + 1):
        bits = ((wide >> b) & 1).astype(np.uint8).reshape(n, groups, GROUP)
        out[b] = np.packbits(bits, axis=2, bitorder="little")[:, :, 0].T
    return out


def subset_sums(q: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors) sums of every subset of eight components."""
    a, dim = q.shape
    groups = max(1, -(-dim // GROUP))
    big = int(np.abs(q).max()) if q.size else 0
    dtype = np.int32 if big < 2 ** 27 else q.dtype
    wide = np.zeros((a, groups * GROUP), q.dtype)
    wide[:, :dim] = q
    wide = wide.T.reshape(groups, GROUP, a).astype(dtype)
    out = np.zeros((groups, 1 << GROUP, a), dtype)
    for j in range(GROUP):
        out[:, 1 << j:2 << j] = out[:, :1 << j] + wide[:, j, None]
    return out


def scores(tables: np.ndarray, planes: np.ndarray, exact: bool) -> np.ndarray:
    """(rows, anchors) inner products; ``exact`` asks for Python integers."""
    bits, groups, n = planes.shape
    total = np.zeros((n, tables.shape[2]), object if exact else np.int64)
    for b in range(bits - 1, -1, -1):
        s = tables[0].take(planes[b, 0], axis=0)
        s = s.astype(object) if exact else s.astype(np.int64)
        for g in range(1, groups):
            s += tables[g].take(planes[b, g], axis=0)
        total *= 2
        if b == bits - 1:
            total -= s
        else:
            total += s
    return total


_CELL = "cell long, lo long, hi long, ids binary, labels binary, planes binary, bits int"
_BLOCK = "block long, lo long, hi long, ids binary, labels binary, vs array<string>"


def _cut(size: int, make, names: list[str]):
    """Rows (vec_id, label, x) in order -> packed groups of ``size`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, have = [], 0

        def flush():
            t = pa.Table.from_batches(part).combine_chunks()
            ids, labels = t.column(0).to_numpy(), t.column(1).to_numpy()
            x = t.column(2).combine_chunks()
            x = x.chunk(0) if isinstance(x, pa.ChunkedArray) else x
            cols = [pa.array([int(ids[0])]), pa.array([int(labels.min())]),
                    pa.array([int(labels.max())]), pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                    pa.array([labels.astype("<i8").tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(cols + make(x), names)
        for b in batches:
            at = 0
            while at < b.num_rows:
                step = min(size - have, b.num_rows - at)
                part.append(b.slice(at, step))
                have, at = have + step, at + step
                if have == size:
                    yield flush()
                    part, have = [], 0
        if have:
            yield flush()
    return run


def _cells(dim: int):
    def make(x):
        p = bit_planes(integers(x, dim))
        return [pa.array([p.tobytes()], pa.binary()), pa.array([len(p)], pa.int32())]
    return _cut(CELL, make, ["cell", "lo", "hi", "ids", "labels", "planes", "bits"])


def _blocks(dim: int):
    def make(x):
        return [pa.array([[str(e) for e in integers(x, dim).ravel()]], pa.list_(pa.string()))]
    return _cut(BLOCK, make, ["block", "lo", "hi", "ids", "labels", "vs"])


def _scored(row, dim: int):
    """ids, labels, vs of a block with ids, labels, planes, bits of a cell ->
    (anchor ids, their labels, candidate ids, their labels, scores) by stripes,
    candidates in ascending id order."""
    qi, ql, qv, ci, cl, cp, bits = row
    qid, qlab = (np.frombuffer(x.as_buffer(), "<i8") for x in (qi, ql))
    cid, clab = (np.frombuffer(x.as_buffer(), "<i8") for x in (ci, cl))
    values = [int(e) for e in qv.as_py()]
    big = max(map(abs, values), default=0)
    bits = bits.as_py()
    # Room for 100 * score in the window test.
    exact = big.bit_length() + bits + max(1, dim).bit_length() > 55
    q = np.array(values, object if exact else np.int64).reshape(len(qid), -1 if values else 0)
    groups = max(1, -(-q.shape[1] // GROUP))
    planes = np.frombuffer(cp.as_buffer(), np.uint8).reshape(bits, groups, len(cid))
    order = np.argsort(cid, kind="stable")
    cid, clab, planes = cid[order], clab[order], planes[:, :, order]
    for lo in range(0, len(qid), STRIPE):
        part = slice(lo, lo + STRIPE)
        yield qid[part], qlab[part], cid, clab, scores(subset_sums(q[part]), planes, exact)


def _number(values: list, wide: bool) -> pa.Array:
    if not wide:
        return pa.array(values, pa.int64())
    return pa.array([max(_LEAST, min(_MOST, Decimal(int(v)))) for v in values],
                    pa.decimal128(38, 0))


def _own_label(k: int, dim: int, wide: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in zip(*b.columns):
                out: list[list] = [[], [], []]
                for qid, qlab, cid, clab, s in _scored(row, dim):
                    for a in range(len(qid)):
                        j = np.flatnonzero((clab == qlab[a]) & (cid != qid[a]))
                        j = j[np.argsort(-s[j, a], kind="stable")[:k]]
                        for col, x in zip(out, ([int(qid[a])] * len(j), cid[j].tolist(),
                                                s[j, a].tolist())):
                            col += x
                if out[0]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[0]), pa.array(out[1]), _number(out[2], wide)],
                        ["anchor_id", "positive_id", "positive_score"])
    return run


def _other_labels(k: int, low: int, high: int, dim: int, wide: bool):
    """As ``_own_label``, with each block's positives (anchor, positive, score)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in zip(*b.columns):
                asked: dict[int, list] = {}
                for p in row[7].as_py():
                    asked.setdefault(p["anchor_id"], []).append(
                        (p["positive_id"], int(p["positive_score"])))
                out: list[list] = [[], [], [], [], []]
                for qid, qlab, cid, clab, s in _scored(row[:7], dim):
                    for a, anchor in enumerate(qid.tolist()):
                        wants = asked.get(anchor)
                        if not wants:
                            continue
                        col = s[:, a]
                        least = min(low * p for _, p in wants)
                        most = max(high * p for _, p in wants)
                        j = np.flatnonzero((clab != qlab[a]) & (100 * col >= least)
                                           & (100 * col <= most))
                        if not len(j):
                            continue
                        j = j[np.argsort(-col[j], kind="stable")]
                        v = 100 * col[j]
                        for pid, p in wants:
                            fit = j[np.flatnonzero((v >= low * p) & (v <= high * p))[:k]]
                            for c, x in zip(out, ([anchor] * len(fit), [pid] * len(fit),
                                                  cid[fit].tolist(), [p] * len(fit),
                                                  col[fit].tolist())):
                                c += x
                if out[0]:
                    yield pa.RecordBatch.from_arrays(
                        [*map(pa.array, out[:3]), _number(out[3], wide), _number(out[4], wide)],
                        ["anchor_id", "positive_id", "negative_id", "positive_score",
                         "negative_score"])
    return run


def _home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for block, ids in zip(b.column(0).to_pylist(), b.column(1)):
            own = np.frombuffer(ids.as_buffer(), "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), block)), pa.array(own)],
                                             ["block", "anchor_id"])


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95) -> DataFrame:
    """``vectors`` as of ``labelled_vectors``; ``anchors`` (vec_id) names the rows
    that ask.  For each anchor and each of its best ``positives`` rows of its own
    label, the best ``negatives`` rows of other labels with a score of ``low`` to
    ``high`` percent of the positive's."""
    spark = vectors.sparkSession
    small_batches(spark)
    result = ("anchor_id long, positive_id long, rank int, negative_id long, "
              "positive_score long, negative_score long")
    vectors = stored(vectors, "labelled")
    size = vectors.agg(
        F.count("*").alias("n"), F.max(F.size("x")).alias("d"),
        F.max(F.aggregate("x", F.lit(0.0), lambda m, e: F.greatest(m, F.abs(e)))).alias("m")).first()
    if not size["n"]:
        return spark.createDataFrame([], result)
    dim = max(1, size["d"])
    most = size["m"] * SCALE + 1.0
    wide = dim * most * most >= 2.0 ** 62
    number = "decimal(38,0)" if wide else "long"
    n = width(spark)
    # Neighbouring ranges are put together, so that cells are full however many
    # partitions the session deals rows to.
    cells = stored(vectors.repartitionByRange(n, "label", "vec_id")
                   .coalesce(max(1, -(-size["n"] // (4 * CELL))))
                   .sortWithinPartitions("label", "vec_id").mapInArrow(_cells(dim), _CELL), "negative-cells")
    asked = vectors.join(anchors.select("vec_id").distinct(), "vec_id", "left_semi")
    blocks = stored(asked.repartitionByRange(n, "label", "vec_id")
                    .coalesce(max(1, -(-size["n"] // (8 * CELL)))).sortWithinPartitions("label", "vec_id").select("vec_id", "label", "x")
                    .mapInArrow(_blocks(dim), _BLOCK), "anchor-blocks")

    block_cols = ["ids", "labels", "vs"]
    cell_cols = [F.col("ids").alias("cids"), F.col("labels").alias("clabels"), "planes", "bits"]
    load = cells.select("cell", *cell_cols)
    inputs = [*block_cols, "cids", "clabels", "planes", "bits"]

    def spread(df: DataFrame, name: str) -> DataFrame:
        own = df.select(name, "labels").mapInArrow(_labels(name), f"{name} long, label long")
        return own.distinct()

    # Positives: blocks meet the cells that hold one of their labels.
    near = (spread(blocks, "block").join(spread(cells, "cell"), "label")
            .select("block", "cell").distinct())
    own = (near.join(blocks.select("block", *block_cols), "block").join(load, "cell")
           .select(*inputs).mapInArrow(
               _own_label(positives, dim, wide),
               f"anchor_id long, positive_id long, positive_score {number}"))
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    chosen = stored(own.withColumn("i", F.row_number().over(best))
                    .where(F.col("i") <= positives).drop("i"), "positives")

    # Negatives: every block meets every cell, a cell's number being the key.
    numbers = stored(cells.select("cell").withColumn(
        "number", F.row_number().over(Window.orderBy("cell"))), "cell-numbers")
    count = numbers.count()
    of = (blocks.select("block", "ids").mapInArrow(_home, "block long, anchor_id long")
          .join(chosen, "anchor_id").groupBy("block")
          .agg(F.collect_list(F.struct("anchor_id", "positive_id", "positive_score")).alias("asked")))
    full = (blocks.select("block", *block_cols).join(of, "block")
            .withColumn("number", F.explode(F.sequence(F.lit(1), F.lit(count))))
            .repartition(max(1, min(count, 8 * n)), "number"))
    found = (full.join(load.join(numbers, "cell"), "number").select(*inputs, "asked")
             .mapInArrow(_other_labels(negatives, low, high, dim, wide),
                         "anchor_id long, positive_id long, negative_id long, "
                         f"positive_score {number}, negative_score {number}"))
    first = (Window.partitionBy("anchor_id", "positive_id")
             .orderBy(F.desc("negative_score"), "negative_id"))

    def long(name: str) -> Column:
        if not wide:
            return F.col(name)
        most = F.lit(Decimal(2 ** 63 - 1)).cast("decimal(38,0)")
        return F.least(F.greatest(F.col(name), -most), most).cast("long").alias(name)
    return (found.withColumn("rank", F.row_number().over(first))
            .where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", long("positive_score"),
                    long("negative_score")))


def _labels(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, labels in zip(b.column(0).to_pylist(), b.column(1)):
                own = np.unique(np.frombuffer(labels.as_buffer(), "<i8"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), key)), pa.array(own)], [name, "label"])
    return run


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = labelled_vectors(read(spark, sf_dir, "embeddings"), moved)
    return mine(vectors, vectors.select("vec_id").where("vec_id % 50 = 0"))


#: DuckDB twin of the query.
HARD_NEGATIVE_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
         CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS i
  FROM s WHERE same),
n AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score,
         s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
                            ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id
  WHERE p.i <= 5 AND NOT s.same AND 50 * p.positive_score <= 100 * s.score
    AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score,
       negative_score
FROM n WHERE rank <= 3
"""

"""Source divergence audit by a minimal-perfect-hash recount.

First pass: exact document frequencies of the terms of each language, counted
in the tasks and summed by Spark; terms below ``LEAST_DOCS`` go.  What is kept
is dealt into shards of about ``SHARD_KEYS`` terms; each gets a minimal perfect
hash and keeps its keys in slot order.  Second pass: the shards are broadcast
and each task recounts its texts into dense arrays, one a (language, source)
group, one slot a kept term.  A word's slot counts only if the stored key is
that word.  A broadcast holds at most ``ROUND_BYTES``; more shards take more
rounds over the texts, so its size never grows with the data.

From the dense counts, integers only: p = 1 + floor(10^9 (count + 5) / (N + 5 V))
for every kept term, counted or not.  Per pair of sources of a language the sum
of |p - q|; per source the terms above their language's p, the first 50.

Terms are the runs of letters A-Z and of characters beyond ASCII; only A-Z is
lower-cased.  Hot groups: counts are added up in the tasks first, and a group's
counts are spread over its language's shards.

Defined results: null text, lang or source count as ''; repeated rows count
each; a group without terms, or of a language without kept terms, keeps its
``pair`` rows (value 0 if V = 0); ties go to the smaller item in UTF-8 order; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citystream.llm.common import mix64, read, small_batches, stored

LEAST_DOCS = 30
TOP_TERMS = 50
SMOOTH = 5
#: Terms in a shard (mean); bytes of shards in one broadcast.
SHARD_KEYS, ROUND_BYTES = 4096, 8 << 20
#: Entries of a task's frequency table, and bytes of its dense counts, at
#: which they leave the task and start anew.
TABLE_TERMS, DENSE_BYTES = 500_000, 96 << 20
#: Sources of one language compared in one task.
SOURCES = 128
#: Stored keys above this length are kept as a digest.
KEY_BYTES = 48

_TERM = bytes(b if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_rng = np.random.default_rng(1212)
_BYTE = _rng.integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def terms(text: bytes) -> list[bytes]:
    return text.lower().translate(_TERM).split()


def _rows(b: pa.RecordBatch):
    """(lang, source, text) of a batch, text as UTF-8."""
    cols = [b.column(i).cast(pa.binary()).to_pylist() for i in range(3)]
    for lang, source, text in zip(*cols):
        yield lang or b"", source or b"", text or b""


def _inputs(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")])


# ---- first pass: document frequencies -------------------------------------

def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables: dict[bytes, Counter] = {}

    def leave():
        for lang, c in tables.items():
            n = len(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * n, pa.binary()).cast(pa.string()),
                 pa.array(list(c), pa.binary()).cast(pa.string()),
                 pa.array(list(c.values()), pa.int64())], ["lang", "term", "docs"])
        tables.clear()
    for b in batches:
        for lang, _, text in _rows(b):
            tables.setdefault(lang, Counter()).update(set(terms(text)))
        if sum(map(len, tables.values())) > TABLE_TERMS:
            yield from leave()
    yield from leave()


def kept_terms(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, docs) of the terms in at least ``least`` documents."""
    return (_inputs(docs).mapInArrow(_frequencies, "lang string, term string, docs long")
            .groupBy("lang", "term").agg(F.sum("docs").alias("docs"))
            .where(F.col("docs") >= least))


# ---- sharded minimal perfect hash ------------------------------------------

def key_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word."""
    if not words:
        return np.zeros(0, np.uint64)
    b = np.frombuffer(b"".join(words), np.uint8)
    n = np.fromiter(map(len, words), np.int64, len(words))
    first = np.cumsum(n) - n
    pos = np.arange(len(b)) - np.repeat(first, n)
    power = np.full(int(n.max()), 0x9E3779B97F4A7C15, np.uint64)
    power[0] = 1
    h = np.add.reduceat(_BYTE[b] * np.cumprod(power)[pos], first)
    return mix64(h + n.astype(np.uint64))


def _stored(word: bytes) -> bytes:
    if len(word) <= KEY_BYTES:
        return word
    return b" " + hashlib.blake2b(word, digest_size=32).digest()


def _slot(h: np.ndarray, level: int, bits: np.ndarray) -> np.ndarray:
    return (mix64(h + np.uint64((level + 1) * 0xA24BAED4963EE407 % 2 ** 64))
            % bits.astype(np.uint64)).astype(np.int64)


def build_shard(words: list[bytes]) -> tuple[list[bytes], list[int]]:
    """(levels, order): bit arrays, one a level; keys that are alone on their bit
    stay there, the rest go on.  ``order`` lists the words slot by slot."""
    h, at = key_hashes(words), np.arange(len(words))
    if len(np.unique(h)) < len(h):
        raise ValueError("two kept terms have one hash")
    levels, order = [], []
    while len(at):
        bits = max(64, -(-len(at) * 2 // 8) * 8)
        spot = _slot(h[at], len(levels), np.array([bits]))
        alone = np.bincount(spot, minlength=bits)[spot] == 1
        mask = np.zeros(bits, np.uint8)
        mask[spot[alone]] = 1
        levels.append(np.packbits(mask).tobytes())
        stay = at[alone]
        order += stay[np.argsort(spot[alone])].tolist()
        at = at[~alone]
    return levels, order


def _build(t: pa.Table) -> pa.Table:
    """The kept terms of one (lang, shard) -> its row."""
    words = t.column("term").cast(pa.binary()).to_pylist()
    levels, order = build_shard(words)
    keys = [_stored(words[i]) for i in order]
    return pa.table({
        "lang": t.column("lang").slice(0, 1), "shard": t.column("shard").slice(0, 1),
        "n": pa.array([len(keys)]), "levels": pa.array([levels], pa.list_(pa.binary())),
        "keys": pa.array([keys], pa.list_(pa.binary())),
        "terms": pa.array([[words[i] for i in order]], pa.list_(pa.binary())).cast(
            pa.list_(pa.string())),
        "bytes": pa.array([sum(map(len, keys)) + sum(map(len, levels)) + 16 * len(keys)])})


_SHARD = ("lang string, shard int, n long, levels array<binary>, keys array<binary>, "
          "terms array<string>, bytes long")


def _route(h: np.ndarray, shards) -> np.ndarray:
    """Shard of each key of a language with ``shards`` shards."""
    return (mix64(h ^ np.uint64(0x5851F42D4C957F2D))
            % np.asarray(shards, np.uint64)).astype(np.int64)


def _routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        h = key_hashes(b.column(1).cast(pa.binary()).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(_route(h, b.column(2).to_numpy()).astype(np.int32)), b.column(1)],
            ["lang", "shard", "term"])


def shard_terms(kept: DataFrame) -> DataFrame:
    sizes = kept.groupBy("lang").agg(F.ceil(F.count("*") / SHARD_KEYS).cast("long").alias("shards"))
    return (kept.join(sizes, "lang").select("lang", "term", "shards")
            .mapInArrow(_routed, "lang string, shard int, term string")
            .groupBy("lang", "shard").applyInArrow(_build, _SHARD))


class Lookup:
    """The shards of one round, side by side: bits, ranks and keys in flat arrays."""

    def __init__(self, rows: list[dict]):
        self.shards = [(r["lang"].encode(), r["shard"], r["n"]) for r in rows]
        self.of: dict[bytes, dict[int, int]] = {}
        self.total = {}
        for i, r in enumerate(rows):
            self.of.setdefault(r["lang"].encode(), {})[r["shard"]] = i
            self.total[r["lang"].encode()] = r["shards"]
        deep = max((len(r["levels"]) for r in rows), default=0)
        self.base = np.cumsum([0] + [r["n"] for r in rows])
        taken = self.base[:-1].copy()
        self.levels = []
        for level in range(deep):
            masks = [np.unpackbits(np.frombuffer(r["levels"][level], np.uint8))
                     if level < len(r["levels"]) else np.zeros(0, np.uint8) for r in rows]
            size = np.array([len(m) for m in masks])
            rank = [np.cumsum(m, dtype=np.int64) - m + t for m, t in zip(masks, taken)]
            taken = taken + np.array([int(m.sum()) for m in masks])
            self.levels.append((size, np.cumsum(size) - size, np.concatenate(masks),
                                np.concatenate(rank)))
        self.keys = np.array([k for r in rows for k in r["keys"]], object)

    def slots(self, lang: bytes, words: list[bytes]) -> np.ndarray:
        """Slot of each word among all slots of the round, -1 where the stored
        key is another one."""
        out = np.full(len(words), -1, np.int64)
        own = self.of.get(lang)
        if not own or not words:
            return out
        h = key_hashes(words)
        where = np.full(self.total[lang], -1, np.int64)
        where[list(own)] = list(own.values())
        shard = where[_route(h, self.total[lang])]
        left = np.flatnonzero(shard >= 0)
        for level, (size, first, mask, rank) in enumerate(self.levels):
            left = left[size[shard[left]] > 0]
            if not len(left):
                break
            s = shard[left]
            spot = first[s] + _slot(h[left], level, size[s])
            hit = mask[spot] == 1
            out[left[hit]] = rank[spot[hit]]
            left = left[~hit]
        found = np.flatnonzero(out >= 0)
        asked = np.empty(len(found), object)
        asked[:] = [_stored(words[i]) for i in found]
        out[found[self.keys[out[found]] != asked]] = -1
        return out


# ---- second pass: dense counts ----------------------------------------------

_COUNTS = "lang string, source string, shard int, n long, at binary, counts binary"
_COUNT_NAMES = ["lang", "source", "shard", "n", "at", "counts"]


def _count_row(lang, source, shard, dense: np.ndarray) -> tuple:
    """Counts of a shard: all slots, or the counted ones if that is shorter."""
    at = np.flatnonzero(dense)
    if 12 * len(at) < 8 * len(dense):
        return (lang, source, shard, len(dense), at.astype("<u4").tobytes(),
                dense[at].astype("<i8").tobytes())
    return lang, source, shard, len(dense), None, dense.astype("<i8").tobytes()


def _dense(n: int, at, counts) -> np.ndarray:
    c = np.frombuffer(counts, "<i8")
    if at is None:
        return c
    out = np.zeros(n, np.int64)
    out[np.frombuffer(at, "<u4")] = c
    return out


def _count_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    texts = [pa.array(c, pa.binary()).cast(pa.string()) for c in cols[:2]]
    return pa.RecordBatch.from_arrays(
        [*texts, pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int64()),
         pa.array(cols[4], pa.binary()), pa.array(cols[5], pa.binary())], _COUNT_NAMES)


def _recount(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(shared.value)
        of_lang = {lang: sorted(own.values()) for lang, own in look.of.items()}
        # A language's shards are neighbours: one dense array a group.
        span = {lang: (look.base[own[0]], look.base[own[-1] + 1]) for lang, own in of_lang.items()}
        groups: dict[tuple, np.ndarray] = {}

        def leave():
            for (lang, source), dense in groups.items():
                lo = span[lang][0]
                for i in of_lang[lang]:
                    part = dense[look.base[i] - lo:look.base[i + 1] - lo]
                    if part.any():
                        yield _count_batch([_count_row(lang, source, look.shards[i][1], part)])
            groups.clear()

        def count(seen):
            for group, c in seen.items():
                lo, hi = span[group[0]]
                if group not in groups:
                    if 8 * (sum(map(len, groups.values())) + hi - lo) > DENSE_BYTES:
                        yield from leave()
                    groups[group] = np.zeros(hi - lo, np.int64)
                slots = look.slots(group[0], list(c))
                hit = slots >= 0
                # Slots are distinct, as the words are.
                groups[group][slots[hit] - lo] += np.fromiter(c.values(), np.int64, len(c))[hit]
            seen.clear()

        seen: dict[tuple, Counter] = {}
        for b in batches:
            for lang, source, text in _rows(b):
                if lang in span:
                    seen.setdefault((lang, source), Counter()).update(terms(text))
            if sum(map(len, seen.values())) > TABLE_TERMS:
                yield from count(seen)
        yield from count(seen)
        yield from leave()
    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (lang, source, shard) -> their sums, one row each."""
    last, total = None, None
    for b in batches:
        cols = [b.column(i).cast(pa.binary()).to_pylist() if i < 2
                else b.column(i).to_pylist() for i in range(6)]
        out = []
        for lang, source, shard, n, at, counts in zip(*cols):
            if (lang, source, shard) != last:
                if last is not None:
                    out.append(_count_row(*last, total))
                last, total = (lang, source, shard), np.zeros(n, np.int64)
            total += _dense(n, at, counts)
        if out:
            yield _count_batch(out)
    if last is not None:
        yield _count_batch([_count_row(*last, total)])


def _added(counts: DataFrame) -> DataFrame:
    keys = ["lang", "source", "shard"]
    return (counts.repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(_add, _COUNTS))


def recount(docs: DataFrame, shards: DataFrame) -> DataFrame:
    """Counts of every kept term in every (lang, source) group, packed by shard."""
    spark = docs.sparkSession
    total = shards.agg(F.sum("bytes")).first()[0] or 0
    per = shards.groupBy("lang").agg(F.count("*").cast("int").alias("shards"))
    whole = shards.join(per, "lang").select("lang", "shard", "shards", "n", "levels", "keys", "bytes")
    if total > ROUND_BYTES:
        # Only this list of shards is ordered in one place, not their terms.
        run = Window.orderBy("lang", "shard").rowsBetween(Window.unboundedPreceding, -1)
        rounds = stored(shards.select("lang", "shard", "bytes").withColumn(
            "round", F.floor(F.coalesce(F.sum("bytes").over(run), F.lit(0)) / ROUND_BYTES)),
            "rounds").drop("bytes")
        last = rounds.agg(F.max("round")).first()[0]
        whole = stored(whole.join(rounds, ["lang", "shard"]), "rounds-of-shards")
    else:
        whole, last = whole.withColumn("round", F.lit(0)), 0
    parts = []
    for r in range(last + 1):
        rows = (whole.where(F.col("round") == r).drop("round", "bytes")
                .orderBy("lang", "shard").toArrow().to_pylist())
        shared = spark.sparkContext.broadcast(rows)
        parts.append(_inputs(docs).mapInArrow(_recount(shared), _COUNTS))
        if len(parts) == 8 and r < last:  # few broadcasts alive at a time
            parts = [stored(_union(parts), "some-counts")]
    return stored(_added(_union(parts)), "counts")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- scaled shares and their differences --------------------------------------

def shares(counts: np.ndarray, n: np.ndarray, v: int) -> np.ndarray:
    """1 + floor(10^9 (count + 5) / (N + 5 V)), exactly (10^9 = 31250 * 32000): two
    divisions whose products stay within 64 bits for N + 5 V below 2.8e14."""
    d = np.asarray(n, np.int64) + SMOOTH * v
    q, r = np.divmod((counts + SMOOTH) * 31250, d)
    return 1 + q * 32000 + r * 32000 // d


def _pair_sums(t: pa.Table) -> pa.Table:
    """One shard's counts of up to two blocks of sources -> its part of |p - q|
    summed, for every pair of the two blocks (both ways)."""
    lang, x, y = t.column("lang")[0].as_py(), t.column("x")[0].as_py(), t.column("y")[0].as_py()
    n, v = t.column("n")[0].as_py(), t.column("v")[0].as_py()
    number, block = t.column("number").to_numpy(), t.column("block").to_numpy()
    p = np.empty((t.num_rows, n), np.int64)
    for i, (at, counts, total) in enumerate(zip(*(t.column(c).to_pylist()
                                                  for c in ("at", "counts", "total")))):
        c = np.zeros(n, np.int64) if counts is None else _dense(n, at, counts)
        p[i] = shares(c, total, v)
    rows = []
    other = np.flatnonzero(block == y)
    for i in np.flatnonzero(block == x):
        j = other if x != y else np.flatnonzero(number > number[i])
        sums = np.abs(p[j] - p[i]).sum(1)
        rows += [(int(number[i]), int(number[k]), int(s)) for k, s in zip(j, sums)]
    a, b, s = zip(*rows) if rows else ([], [], [])
    return pa.table({"lang": pa.array([lang] * len(rows), pa.string()),
                     "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()),
                     "part": pa.array(s, pa.int64())})


def _top_terms(top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A group's shard with its language's counts and terms -> its terms above
        the language's share, the ``top`` first of the shard."""
        for b in batches:
            for r in b.to_pylist():
                c = _dense(r["n"], r["at"], r["counts"])
                p = shares(c, r["total"], r["v"])
                q = shares(_dense(r["n"], r["all_at"], r["all_counts"]), r["all_total"], r["v"])
                over = np.flatnonzero((c > 0) & (p > q))
                f = (p - q)[over]
                if len(over) > top:
                    least = np.partition(f, len(f) - top)[len(f) - top]
                    over, f = over[f >= least], f[f >= least]
                first = sorted(zip((-f).tolist(), (r["terms"][i].encode() for i in over)))[:top]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["lang"]] * len(first), pa.string()),
                     pa.array([r["source"]] * len(first), pa.string()),
                     pa.array([t for _, t in first], pa.binary()).cast(pa.string()),
                     pa.array([-x for x, _ in first], pa.int64())],
                    ["lang", "source", "item", "value"])
    return run


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1),
             pa.array([int(np.frombuffer(c.as_buffer(), "<i8").sum()) for c in b.column(2)],
                      pa.int64())], ["lang", "source", "total"])


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank of every (lang, source) group."""
    spark = docs.sparkSession
    small_batches(spark)
    kept = stored(kept_terms(docs, least), "kept-terms")
    empty = F.coalesce(F.col("lang").cast("string"), F.lit("")), F.coalesce(
        F.col("source").cast("string"), F.lit(""))
    names = docs.select(empty[0].alias("lang"), empty[1].alias("source")).distinct()
    order = Window.partitionBy("lang").orderBy("source")
    groups = stored(names.withColumn("number", F.row_number().over(order).cast("long"))
                    .withColumn("block", F.floor((F.col("number") - 1) / SOURCES)), "groups")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"))
    shards = stored(shard_terms(kept), "shards")
    counts = recount(docs, shards)

    totals = stored(counts.select("lang", "source", "counts")
                    .mapInArrow(_sum_counts, "lang string, source string, total long")
                    .groupBy("lang", "source").agg(F.sum("total").alias("total")), "totals")
    totals = groups.join(totals, ["lang", "source"], "left").withColumn(
        "total", F.coalesce("total", F.lit(0).cast("long")))

    # Pairs of sources: shard by shard, block of sources by block of sources.
    blocks = groups.groupBy("lang").agg((F.max("block") + 1).alias("blocks"))
    meet = (totals.join(blocks, "lang")
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other")))
    sums = (meet.join(shards.select("lang", "shard", "n").join(sizes, "lang"), "lang")
            .join(counts.drop("n"), ["lang", "source", "shard"], "left")
            .select("lang", "shard", "x", "y", "number", "block", "n", "v", "total", "at", "counts")
            .groupBy("lang", "shard", "x", "y")
            .applyInArrow(_pair_sums, "lang string, a long, b long, part long")
            .groupBy("lang", "a", "b").agg(F.sum("part").alias("value")))
    sums = stored(sums.select("lang", "a", "b", "value").union(
        sums.select("lang", "b", "a", "value")), "pair-sums")
    own = groups.select("lang", "source", F.col("number").alias("a"))
    item = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("b"))
    pairs = (own.join(item, "lang").where("a <> b").join(sums, ["lang", "a", "b"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item",
                     F.coalesce("value", F.lit(0).cast("long")).alias("value")))

    # Terms above their language's share.
    every = _added(counts.withColumn("source", F.lit(""))).select(
        "lang", "shard", F.col("at").alias("all_at"), F.col("counts").alias("all_counts"))
    per_lang = totals.groupBy("lang").agg(F.sum("total").alias("all_total"))
    over = (counts.join(totals.select("lang", "source", "total"), ["lang", "source"])
            .join(per_lang.join(sizes, "lang"), "lang")
            .join(every.join(shards.select("lang", "shard", "terms"), ["lang", "shard"]),
                  ["lang", "shard"])
            .mapInArrow(_top_terms(top), "lang string, source string, item string, value long")
            .select("lang", "source", F.lit("term").alias("part"), "item", "value"))
    rank = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return (pairs.unionByName(over).withColumn("rank", F.row_number().over(rank))
            .where((F.col("part") == "pair") | (F.col("rank") <= top)))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"))


#: DuckDB twin of the query.
DIVERGENCE_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts
  FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM w JOIN kept USING (lang, term)
      GROUP BY lang, source, term),
n AS (SELECT g.lang, g.source, coalesce(sum(c.c), 0) AS n FROM g LEFT JOIN c USING (lang, source)
      GROUP BY g.lang, g.source),
p AS (
  SELECT n.lang, n.source, k.term, coalesce(c.c, 0) AS c,
         CAST(1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 5)) // (n.n + 5 * v.v)
              AS BIGINT) AS p
  FROM n JOIN kept k USING (lang) JOIN v USING (lang)
  LEFT JOIN c ON c.lang = n.lang AND c.source = n.source AND c.term = k.term),
ln AS (SELECT lang, sum(n) AS n FROM n GROUP BY lang),
lp AS (
  SELECT k.lang, k.term,
         CAST(1 + (CAST(1000000000 AS HUGEINT) * (coalesce(sum(c.c), 0) + 5))
              // (any_value(ln.n) + 5 * any_value(v.v)) AS BIGINT) AS q
  FROM kept k JOIN ln USING (lang) JOIN v USING (lang)
  LEFT JOIN c ON c.lang = k.lang AND c.term = k.term GROUP BY k.lang, k.term),
diff AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         CAST(coalesce(diff.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN diff ON diff.lang = a.lang AND diff.source = a.source AND diff.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, p.p - lp.q
  FROM p JOIN lp USING (lang, term) WHERE p.c > 0 AND p.p > lp.q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
      FROM f)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
FROM r WHERE part = 'pair' OR rank <= 50
"""

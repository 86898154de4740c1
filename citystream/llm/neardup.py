"""MinHash near-duplicates by a multi-index Hamming join.

A document's set is its distinct 5-word shingles (64-bit hashes); documents
with equal sets form one class, and all work is on classes.  Each class has a
signature of ``SYMBOLS`` min-hash values, ``b`` = 16 bits of each.  The join
splits a signature into ``CHUNKS`` chunks.  By the pigeonhole principle two
signatures that differ in at most ``RADIUS`` symbols differ in at most
``ERRORS`` = 1 symbol of some chunk, so both have a key (chunk with one symbol
left out) in common: *every* pair under the radius meets.  A pair at the
similarity bound differs in Binomial(65, 0.15) symbols: 10 of 65 expected, and
more than 25 about once in a million.  Every link is confirmed on full sets.

Large buckets (a group of copies may hold a third of all rows) are never
paired off.  First all members are compared with their bucket's smallest class,
which joins most of a group with one link a member.  Buckets that still hold
several components go on: members of larger ones (over ``SMALL``) are packed,
signatures and full sets, into blocks; small buckets give their pairs of
different components within the radius where one is not packed.  Block pairs
that share a bucket are compared block against block, where candidates are confirmed on the spot
and only the links that join something leave.  No pair is dropped.

Defined results: null or word-less text -- empty set, ``n_shingles`` 0, a
component of its own; fewer than five words -- one shingle of the whole
sequence; repeated rows -- one class, each row in the output; null doc_id --
linked with nothing, component null, kept; ties -- the smallest doc_id names
the component.  Other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.llm.bpe import slices
from citystream.llm.common import components, mix64, read, stored, trimmed

WORDS = 5
CHUNKS, PER_CHUNK, ERRORS = 13, 5, 1
SYMBOLS = CHUNKS * PER_CHUNK
#: Largest signature distance that the keys guarantee to find.
RADIUS = CHUNKS * (ERRORS + 1) - 1
#: Members of a bucket up to which its open pairs are listed.
SMALL = 32
#: Classes, and bytes of full sets, in one block of larger buckets.
BLOCK, BLOCK_BYTES = 512, 8 << 20

_rng = np.random.default_rng(20240)
_BYTE = _rng.integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORD = _rng.integers(1, 2 ** 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = _rng.integers(1, 2 ** 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(1, 2 ** 63, SYMBOLS, dtype=np.uint64)
_SALT = mix64(np.arange(1, SYMBOLS + 1, dtype=np.uint64))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of the text it stands in); words are runs
    without ASCII white space, A-Z lower-cased."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    starts = np.cumsum([0] + [len(r) + 1 for r in raw[:-1]]) if raw else np.zeros(0, np.int64)
    b = np.frombuffer(b"\n".join(raw).lower(), np.uint8)
    if not len(b):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~((b == 32) | ((b >= 9) & (b <= 13)))
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    at, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lens = end - at
    first = np.cumsum(lens) - lens
    pos = np.arange(int(lens.sum())) - np.repeat(first, lens)
    power = np.full(int(lens.max()), 0x9E3779B97F4A7C15, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    h = np.add.reduceat(_BYTE[b[inside]] * power[pos], first)
    return (mix64(h + lens.astype(np.uint64)),
            np.searchsorted(starts, at, "right") - 1)


def shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts, set size of each text)."""
    w, doc = word_hashes(texts)
    n_words = np.bincount(doc, minlength=len(texts))
    if len(w) >= WORDS:
        h = sum(w[j:len(w) - WORDS + 1 + j] * _WORD[j] for j in range(WORDS))
        own = doc[:-WORDS + 1]
        whole = own == doc[WORDS - 1:]
        h, own = mix64(h[whole]), own[whole]
    else:
        h, own = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((n_words > 0) & (n_words < WORDS))
    if len(short):
        first = np.cumsum(n_words) - n_words
        extra = []
        for i in short:
            ws = w[first[i]:first[i] + n_words[i]]
            extra.append(np.append(ws * _WORD[:len(ws)], _BYTE[len(ws)]).sum(dtype=np.uint64))
        h = np.concatenate([h, mix64(np.array(extra, np.uint64))])
        own = np.concatenate([own, short])
        order = np.argsort(own, kind="stable")
        h, own = h[order], own[order]
    n = np.bincount(own, minlength=len(texts))
    end = np.cumsum(n)
    for lo, hi in zip(end - n, end):
        h[lo:hi].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
    return h[new], np.bincount(own[new], minlength=len(texts))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, n, class hash, signature of each text."""
    for b in batches:
        texts = [t or "" for t in b.column(1).to_pylist()]
        for lo, hi in slices(texts):
            h, n = shingle_sets(texts[lo:hi])
            full = np.flatnonzero(n)
            first = (np.cumsum(n) - n)[full]
            sig = np.zeros((hi - lo, SYMBOLS), "<u2")
            cls = np.zeros(hi - lo, np.int64)
            if len(full):
                for k in range(SYMBOLS):
                    low = np.minimum.reduceat(h * _MUL[k] + _ADD[k], first)
                    sig[full, k] = (mix64(low) & np.uint64(0xFFFF)).astype("<u2")
                total = np.add.reduceat(mix64(h + _ADD[0]), first)
                cls[full] = mix64(total ^ mix64(n[full].astype(np.uint64))).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)), pa.array(cls),
                 pa.array([s.tobytes() if k else None for s, k in zip(sig, n)], pa.binary())],
                ["doc_id", "n", "cls", "sig"])


def _sig_array(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), "<u2").reshape(-1, SYMBOLS)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk with each of its symbols left out: 65 keys a class."""
    for b in batches:
        for lo in range(0, b.num_rows, 4096):
            part = b.slice(lo, 4096)
            cls = part.column(0).to_numpy()
            sig = _sig_array(part.column(1)).reshape(-1, CHUNKS, PER_CHUNK).astype(np.uint64)
            out = []
            for c in range(CHUNKS):
                for skip in range(PER_CHUNK):
                    rest = [s for s in range(PER_CHUNK) if s != skip]
                    k = np.zeros(len(sig), np.uint64)
                    for s in rest:
                        k = (k << np.uint64(16)) | sig[:, c, s]
                    out.append(mix64(k ^ _SALT[c * PER_CHUNK + skip]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out)), pa.array(np.tile(cls, SYMBOLS))], ["key", "cls"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """cls, full set (sorted 64-bit hashes) of each text."""
    for b in batches:
        texts = [t or "" for t in b.column(1).to_pylist()]
        for lo, hi in slices(texts):
            h, n = shingle_sets(texts[lo:hi])
            at = np.concatenate([[0], np.cumsum(n)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(lo, hi - lo),
                 pa.array([h[i:j].tobytes() for i, j in zip(at, at[1:])], pa.binary())],
                ["cls", "sh"])


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                p = np.frombuffer(x.as_buffer(), "<u8")
                q = np.frombuffer(y.as_buffer(), "<u8")
                both = np.sort(np.concatenate([p, q]))
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    return run


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Symbols in which signatures differ, all against all."""
    out = np.empty((len(x), len(y)), np.int16)
    for lo in range(0, len(x), 64):
        out[lo:lo + 64] = (x[lo:lo + 64, None, :] != y[None, :, :]).sum(2)
    return out


def _open_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, cls, label, packed, sig) sorted by key: pairs of a bucket that
    differ in label, are within the radius and are not both in blocks."""
    def flush(parts):
        cls, label, packed, sig = (np.concatenate(x) for x in zip(*parts))
        if packed.all():
            return []
        i, j = np.nonzero(np.triu((_distances(sig, sig) <= RADIUS)
                                  & (label[:, None] != label[None, :])
                                  & ~(packed[:, None] & packed[None, :])))
        return [(cls[i], cls[j])] if len(i) else []

    last, parts = None, []
    for b in batches:
        key, cls, label = (b.column(k).to_numpy() for k in range(3))
        packed = b.column(3).to_numpy(zero_copy_only=False).astype(bool)
        sig = _sig_array(b.column(4))
        cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
        out = []
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            if key[lo] != last and parts:
                out += flush(parts)
                parts = []
            last = key[lo]
            parts.append((cls[lo:hi], label[lo:hi], packed[lo:hi], sig[lo:hi]))
        if out:
            yield _pairs(out)
    if parts and (out := flush(parts)):
        yield _pairs(out)


def _pack_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cls, label, sig, sh) in block order -> blocks, arrays packed."""
    def pack(rows):
        cls, label, sig, sh = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([min(cls)]), pa.array([min(label)]), pa.array([max(label)]),
             pa.array([np.array(cls, "<i8").tobytes()], pa.binary()),
             pa.array([np.array(label, "<i8").tobytes()], pa.binary()),
             pa.array([b"".join(sig)], pa.binary()),
             pa.array([np.array([len(x) // 8 for x in sh], "<i8").tobytes()], pa.binary()),
             pa.array([b"".join(sh)], pa.binary())], _BLOCK_NAMES)

    rows, size = [], 0
    for b in batches:
        for row in zip(*(b.column(i).to_pylist() for i in range(4))):
            if rows and (len(rows) == BLOCK or size + len(row[3]) > BLOCK_BYTES):
                yield pack(rows)
                rows, size = [], 0
            rows.append(row)
            size += len(row[3])
    if rows:
        yield pack(rows)


_BLOCK_NAMES = ["block", "lo", "hi", "cs", "ls", "sigs", "ns", "shs"]
_BLOCK_TYPE = ("block long, lo long, hi long, cs binary, ls binary, sigs binary, ns binary, "
               "shs binary")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for block, cs in zip(b.column(0).to_pylist(), b.column(1)):
            own = np.frombuffer(cs.as_buffer(), "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), block)), pa.array(own)],
                                             ["block", "cls"])


class _Block:
    def __init__(self, cs, ls, sigs, ns, shs):
        self.cls = np.frombuffer(cs.as_buffer(), "<i8")
        self.label = np.frombuffer(ls.as_buffer(), "<i8")
        self.sig = np.frombuffer(sigs.as_buffer(), "<u2").reshape(-1, SYMBOLS)
        self.n = np.frombuffer(ns.as_buffer(), "<i8")
        self.sh = np.frombuffer(shs.as_buffer(), "<u8")
        self.end = np.cumsum(self.n)

    def set_of(self, i: int) -> np.ndarray:
        return self.sh[self.end[i] - self.n[i]:self.end[i]]


def _common(x: _Block, y: _Block, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets of pairs (i, j)."""
    if len(i) > 200:
        # Many pairs: count over the shingles that both blocks have, at once.
        both = np.intersect1d(x.sh, y.sh)
        if len(both) * (len(x.n) + len(y.n)) <= 4e7:
            dense = []
            for b in (x, y):
                at = np.searchsorted(both, b.sh)
                at[at == len(both)] = 0
                hit = both[at] == b.sh if len(both) else np.zeros(len(b.sh), bool)
                m = np.zeros((len(b.n), len(both)), np.float32)
                m[np.repeat(np.arange(len(b.n)), b.n)[hit], at[hit]] = 1
                dense.append(m)
            return (dense[0] @ dense[1].T)[i, j].astype(np.int64)
    out = np.empty(len(i), np.int64)
    for k, (p, q) in enumerate(zip(i, j)):
        z = np.sort(np.concatenate([x.set_of(p), y.set_of(q)]), kind="stable")
        out[k] = (z[1:] == z[:-1]).sum()
    return out


def _block_links(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Block pairs -> confirmed links that join components of the pair."""
        for b in batches:
            for row in zip(*b.columns):
                x, y = _Block(*row[:5]), _Block(*row[5:])
                ok = (_distances(x.sig, y.sig) <= RADIUS) & (x.label[:, None] != y.label[None, :])
                if x.cls[0] == y.cls[0]:
                    ok = np.triu(ok)
                i, j = np.nonzero(ok)
                if not len(i):
                    continue
                c = _common(x, y, i, j)
                good = 100 * c >= percent * (x.n[i] + y.n[j] - c)
                up: dict[int, int] = {}

                def top(v):
                    while up.get(v, v) != v:
                        v = up[v]
                    return v
                out = []
                for p, q in zip(i[good].tolist(), j[good].tolist()):
                    a, z = top(int(x.label[p])), top(int(y.label[q]))
                    if a != z:
                        up[max(a, z)] = min(a, z)
                        out.append((int(x.cls[p]), int(y.cls[q])))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*out)], ["a", "b"])
    return run


def _pairs(out) -> pa.RecordBatch:
    a = np.concatenate([x for x, _ in out])
    b = np.concatenate([y for _, y in out])
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def _rest_links(live: DataFrame, labels: DataFrame, sigs: DataFrame, sets: DataFrame,
                confirmed, percent: int) -> DataFrame:
    """Links between different components of the same bucket."""
    at = (live.join(labels.withColumnRenamed("id", "cls"), "cls", "left")
          .withColumn("label", F.coalesce("label", "cls")))
    open_ = (at.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                   F.count("*").alias("m"))
             .where("lo <> hi").select("key", "m"))
    at = stored(at.join(open_, "key").select("key", "cls", "label", "head", "m"), "open")
    # Classes of larger buckets are packed; in all their buckets, small ones
    # too, they meet block against block.
    hot = (at.where(F.col("m") > SMALL).groupBy("cls")
           .agg(F.min("head").alias("anchor"), F.min("label").alias("label")))
    members = hot.join(sigs, "cls").join(sets, "cls")
    at = at.join(hot.select("cls", F.lit(True).alias("packed")), "cls", "left") \
        .withColumn("packed", F.coalesce("packed", F.lit(False)))
    some = (at.where(F.col("m") <= SMALL).groupBy("key").agg(F.min("packed").alias("all"))
            .where(~F.col("all")).select("key"))
    small = (at.join(some, "key", "left_semi").join(sigs, "cls")
             .select("key", "cls", "label", "packed", "sig")
             .repartition("key").sortWithinPartitions("key")
             .mapInArrow(_open_pairs, "a long, b long").distinct())
    links = confirmed(small, "small")
    # A few blocks a task: neighbouring ranges are put together, so that blocks
    # are full however many partitions the session deals rows to.
    tasks = max(1, -(-hot.count() // (4 * BLOCK)))
    blocks = stored(members.repartitionByRange("anchor", "label", "cls").coalesce(tasks)
                    .sortWithinPartitions("anchor", "label", "cls")
                    .select("cls", "label", "sig", "sh").mapInArrow(trimmed(_pack_blocks), _BLOCK_TYPE),
                    "blocks")
    of = blocks.select("block", "cs").mapInArrow(_members, "block long, cls long")
    packed = at.where("packed").select("key", "cls", "label")
    # Blocks of a bucket's main component alone have nothing to add to each
    # other, so they meet only the others: rows grow with the stragglers.
    main = (packed.groupBy("key", "label").agg(F.count("*").alias("k"))
            .groupBy("key").agg(F.max_by("label", F.struct("k", "label")).alias("main")))
    spots = stored(packed.select("key", "cls").join(of, "cls").select("key", "block").distinct()
                   .join(main, "key").join(blocks.select("block", "lo", "hi"), "block")
                   .select("key", "block", "lo", "hi", F.expr("lo = hi and lo = main").alias("pure")),
                   "spots")
    x, y = spots.where("not pure").alias("x"), spots.alias("y")
    pairs = (x.join(y, F.col("x.key") == F.col("y.key"))
             .where("not (x.lo = x.hi and y.lo = y.hi and x.lo = y.lo)")
             .select(F.least("x.block", "y.block").alias("x"),
                     F.greatest("x.block", "y.block").alias("y")).distinct())

    def load(name: str) -> DataFrame:
        return blocks.select(F.col("block").alias(name),
                             *[F.col(c).alias(f"{name}_{c}") for c in _BLOCK_NAMES[3:]])
    loaded = pairs.join(load("y"), "y").join(load("x"), "x")
    big = (loaded.select(*[f"{n}_{c}" for n in "xy" for c in _BLOCK_NAMES[3:]])
           .mapInArrow(trimmed(_block_links(percent)), "a long, b long"))
    return links.unionByName(stored(big, "block-links"))


def class_links(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(rows, labels): each input row's doc_id, n, cls; each linked class's
    component label (id, label)."""
    rows = stored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                  .mapInArrow(trimmed(_signatures), "doc_id long, n long, cls long, sig binary"),
                  "signatures")
    sigs = rows.where("n > 0 and doc_id is not null").groupBy("cls").agg(F.min("sig").alias("sig"))
    keys = sigs.select("cls", "sig").mapInArrow(trimmed(_keys), "key long, cls long")
    live = stored(keys.join(keys.groupBy("key").agg(F.count("*").alias("m"),
                                                    F.min("cls").alias("head"))
                            .where("m > 1"), "key")
                  .select("key", "cls", "head"), "buckets")
    members = live.select("cls").distinct()
    own = (rows.join(members, "cls", "left_semi").groupBy("cls")
           .agg(F.min("doc_id").alias("doc_id")))
    sets = stored(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .join(own, "doc_id").select("cls", "text")
        .mapInArrow(trimmed(_checked_sets), "cls long, sh binary"), "sets")
    sigs = stored(sigs.join(members, "cls", "left_semi"), "member-signatures")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        x = sets.select(F.col("cls").alias("a"), F.col("sh").alias("sa"))
        y = sets.select(F.col("cls").alias("b"), F.col("sh").alias("sb"))
        return stored(pairs.join(y, "b").join(x, "a").select("a", "b", "sa", "sb")
                      .mapInArrow(_confirm(percent), "a long, b long"), f"{name}-links")

    star = _near(live.where("cls <> head").select(F.col("head").alias("a"), F.col("cls").alias("b"))
                 .distinct(), sigs)
    labels = components(confirmed(star, "star"), "star")
    links = _rest_links(live, labels, sigs, sets, confirmed, percent)
    la = labels.select(F.col("id").alias("a"), F.col("label").alias("la"))
    lb = labels.select(F.col("id").alias("b"), F.col("label").alias("lb"))
    edges = stored(links.join(la, "a", "left").join(lb, "b", "left")
                   .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
                   .where("a <> b").distinct(), "rest-edges")
    if edges.take(1):
        # Components of components; ends that no star had reached are new ids.
        up = components(edges, "rest").select(F.col("id").alias("label"),
                                              F.col("label").alias("top"))
        ends = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
        old = labels.unionByName(ends.join(labels, "id", "left_anti")
                                 .select("id", F.col("id").alias("label")))
        labels = stored(old.join(up, "label", "left")
                        .select("id", F.coalesce("top", "label").alias("label")), "labels")
    return rows, labels


def _near(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """Pairs (a, b) whose signatures are within RADIUS."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = (_sig_array(b.column(2)) != _sig_array(b.column(3))).sum(1)
            yield b.select([0, 1]).filter(pa.array(d <= RADIUS))
    x = sigs.select(F.col("cls").alias("a"), F.col("sig").alias("xa"))
    y = sigs.select(F.col("cls").alias("b"), F.col("sig").alias("xb"))
    return (pairs.join(y, "b").join(x, "a").select("a", "b", "xa", "xb")
            .mapInArrow(run, "a long, b long"))


def _checked_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Full sets of (cls, text) rows whose text has that class: rows that
    repeat a doc_id with another text fall away, equal ones come once a batch."""
    for out in _sets(batches):
        cls, keep, seen = out.column(0).to_pylist(), [], set()
        for c, sh in zip(cls, out.column(1)):
            h = np.frombuffer(sh.as_buffer(), "<u8")
            own = 0
            if len(h):
                with np.errstate(over="ignore"):
                    total = mix64(h + _ADD[0]).sum(dtype=np.uint64)
                own = int(mix64(np.array([total], np.uint64)
                                ^ mix64(np.array([len(h)], np.uint64))).view(np.int64)[0])
            keep.append(own == c and c not in seen)
            seen.add(c)
        yield out.filter(pa.array(keep, pa.bool_()))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * intersection >= ``percent`` * union of their
    sets (``percent`` from 80 on, for which RADIUS is meant)."""
    rows, labels = class_links(docs, percent)
    linked = F.expr("n > 0 and doc_id is not null")
    classes = (rows.where(linked).groupBy("cls").agg(F.min("doc_id").alias("low"))
               .join(labels.withColumnRenamed("id", "cls"), "cls", "left")
               .select("cls", "low", F.coalesce("label", "cls").alias("label")))
    names = classes.groupBy("label").agg(F.min("low").alias("component_id"))
    of = classes.join(names, "label").select("cls", "component_id")
    out = (rows.where(linked).join(of, "cls")
           .select("doc_id", F.col("n").alias("n_shingles"), "component_id"))
    empty = rows.where(~linked).select("doc_id", F.col("n").alias("n_shingles"),
                                       F.col("doc_id").alias("component_id"))
    return out.unionByName(empty).withColumn("kept", F.expr("doc_id <=> component_id"))


def deduplicate(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``docs`` with one document of each component; of rows that repeat a
    doc_id with its text one stays, rows without a doc_id stay."""
    marked = stored(near_duplicates(docs, percent), "near-duplicates")
    gone = marked.where("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    out = docs.join(gone, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")
    seen = marked.where("kept and doc_id is not null").agg(
        F.count("*").alias("n"), F.countDistinct("doc_id").alias("ids")).first()
    if seen["n"] > seen["ids"]:
        named = out.where("doc_id is not null").dropDuplicates(["doc_id", "text"])
        out = named.unionByName(out.where("doc_id is null"))
    return out


#: DuckDB twin: shingles of whole texts, links through an inverted index,
#: components by walking links from every document.
NEAR_DUPLICATE_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
           lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE
           WHEN len(ws) = 0 THEN CAST([] AS UBIGINT[])
           WHEN len(ws) < 5 THEN [hash(array_to_string(ws, ' '))]
           ELSE list_transform(range(1, len(ws) - 3),
                               lambda i: hash(array_to_string(ws[i:i + 4], ' '))) END) AS sh
  FROM w),
n AS (SELECT doc_id, len(sh) AS n_shingles FROM s),
cls AS (SELECT doc_id, md5(array_to_string(list_sort(sh), chr(10))) AS c, n_shingles AS n
        FROM s JOIN n USING (doc_id) WHERE n_shingles > 0),
rep AS (SELECT c, min(doc_id) AS doc_id, min(n) AS n FROM cls GROUP BY c),
inv AS (SELECT r.doc_id, r.n, unnest(s.sh) AS g FROM rep r JOIN s USING (doc_id)),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM inv a JOIN inv b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM rep
  UNION SELECT r.a, e.y FROM reach r JOIN edges e ON r.b = e.x),
comp AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT n.doc_id, n.n_shingles, coalesce(comp.low, n.doc_id) AS component_id,
       coalesce(comp.low, n.doc_id) = n.doc_id AS kept
FROM n LEFT JOIN cls ON n.doc_id = cls.doc_id LEFT JOIN rep ON cls.c = rep.c
LEFT JOIN comp ON comp.a = rep.doc_id
"""


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))

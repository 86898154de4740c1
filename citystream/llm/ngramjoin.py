"""N-gram Jaccard join: rare-first prefix filtering with length, positional and
suffix filters, joined on prefix n-grams and verified once a pair.

A document's set is its distinct ``WORDS``-word shingles, as 48-bit tokens.

1. Frequencies.  Each task packs its texts' tokens, batch by batch, and sends
   every distinct token of a batch once to the part of the token space that it
   belongs to, so a token that a third of all documents hold costs one entry a
   batch.  A part sums the counts and answers with the tokens that two or more
   documents have, with their frequency (in eighths of a power of two, at most).
2. Prefixes.  The order is rare first (frequency, then token; tokens of one
   document come first of all).  Documents at the bound share one of their first
   n - ceil(t n) + 1 tokens; where that prefix holds only tokens that no other
   document has, the document is linked with nothing and leaves here.  What is
   left is grouped into classes of equal sets.  A class keeps its shared tokens:
   no other can be part of an intersection.
3. Join.  Classes meet in the lists of their prefix tokens.  Pairs pass the
   length filter, the positional filter (what can still be common behind the
   token's two positions) and the suffix filter: tokens are dealt to ``BINS``
   by value, the differences of the bins' sizes and the tokens of one document
   bound the symmetric difference from below.  Distinct pairs are verified on
   their sets, once.

Groups of copies may hold a third of all rows, so lists are never paired off.
First all members of a list are verified against its hub, the class with the
fewest tokens of its own.  Lists that still hold several components go on:
members of lists up to ``SMALL`` are paired across components; those of longer
ones are packed, sets included, into blocks in order of component and size, and
blocks meet only if they share a list and are not both of its main component
alone.  A block pair gives only the links that join something.  No link between
different components is lost, so components are exact.

Defined results: null or word-less text -- empty set, ``n_shingles`` 0, a
component of its own; fewer words than ``WORDS`` -- the whole sequence as one
shingle; repeated rows -- one class, each row in the output; null doc_id --
linked with nothing, component null; ties -- the smallest doc_id names the
component; empty table -- no rows.  Other columns are not read.  Sets are
compared by hash: two different shingles of a pair are taken for one with
chance 2^-48.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.llm.bpe import slices
from citystream.llm.common import components, mix64, read, stored
from citystream.llm.neardup import word_hashes

WORDS, PERCENT = 4, 85
BITS, BYTES = 48, 6
#: Tokens (with repeats) in one part of the token space, about.
PART_TOKENS = 1 << 21
#: Bins of the suffix filter.
BINS = 64
#: Members up to which an open list's pairs are listed.
SMALL = 32
#: Classes, and tokens, in one block of longer lists.
BLOCK, BLOCK_TOKENS = 256, 1 << 20

_rng = np.random.default_rng(1313)
_PLACE = _rng.integers(1, 2 ** 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LENGTH = _rng.integers(1, 2 ** 63, WORDS + 1, dtype=np.uint64)
_NO_REF = 2 ** 32 - 1


# ---- packed arrays -----------------------------------------------------------

def planes(x: np.ndarray, size: int) -> bytes:
    """Low ``size`` bytes of each number, byte place by byte place (the constant
    ones then compress away)."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def numbers(raw, size: int) -> np.ndarray:
    a = np.frombuffer(raw, np.uint8).reshape(size, -1)
    out = np.zeros((a.shape[1], 8), np.uint8)
    out[:, :size] = a.T
    return out.view("<u8").ravel()


def pack(ascending: np.ndarray) -> bytes:
    return planes(np.diff(ascending, prepend=np.uint64(0)), BYTES)


def unpack(raw) -> np.ndarray:
    return np.cumsum(numbers(raw, BYTES))


# ---- 1: tokens and frequencies -------------------------------------------------

def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct 64-bit shingle hashes of all texts, set size of each)."""
    w, doc = word_hashes(texts)
    words = np.bincount(doc, minlength=len(texts))
    if len(w) >= WORDS:
        h = sum(w[j:len(w) - WORDS + 1 + j] * _PLACE[j] for j in range(WORDS))
        whole = doc[:len(w) - WORDS + 1] == doc[WORDS - 1:]
        h, own = mix64(h[whole]), doc[:len(w) - WORDS + 1][whole]
    else:
        h, own = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = (words > 0) & (words < WORDS)
    if short.any():
        at = np.flatnonzero(short[doc])
        place = at - (np.cumsum(words) - words)[doc[at]]
        total = np.zeros(len(texts), np.uint64)
        np.add.at(total, doc[at], w[at] * _PLACE[place])
        one = np.flatnonzero(short)
        h = np.concatenate([h, mix64(total[one] + _LENGTH[words[one]])])
        own = np.concatenate([own, one])
        order = np.argsort(own, kind="stable")
        h, own = h[order], own[order]
    n = np.bincount(own, minlength=len(texts))
    end = np.cumsum(n)
    for lo, hi in zip(end - n, end):
        h[lo:hi].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
    return h[new], np.bincount(own[new], minlength=len(texts))


_ROW = "part long, batch long, kind int, ids array<long>, x binary, y binary, z binary"
_DOCS, _LOCAL, _TOKENS = 0, 1, 2


def _table(rows: list[tuple]) -> pa.RecordBatch:
    part, batch, kind, ids, x, y, z = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int64()), pa.array(batch, pa.int64()), pa.array(kind, pa.int32()),
         pa.array(ids, pa.list_(pa.int64())), *(pa.array(c, pa.binary()) for c in (x, y, z))],
        ["part", "batch", "kind", "ids", "x", "y", "z"])


def _requests(parts: int):
    """doc_id, text -> for each batch of texts: its documents (ids, set sizes,
    classes), the tokens that several of them have (token, document), and by
    part every distinct token with its count and, if it is one, its document."""
    shift = np.uint64(BITS - (parts.bit_length() - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = TaskContext.get().partitionId() << 32
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for lo, hi in slices(texts):
                h, n = shingles(texts[lo:hi])
                full = np.flatnonzero(n)
                cls = np.zeros(hi - lo, np.int64)
                if len(full):
                    total = np.add.reduceat(mix64(h + _LENGTH[0]), (np.cumsum(n) - n)[full])
                    cls[full] = mix64(total ^ mix64(n[full].astype(np.uint64))).view(np.int64)
                rows = [(batch % parts, batch, _DOCS, b.column(0).slice(lo, hi - lo).to_pylist(),
                         n.astype("<i8").tobytes(), cls.tobytes(), None)]
                token = h >> np.uint64(64 - BITS)
                order = np.argsort(token, kind="stable")
                token = token[order]
                doc = np.repeat(np.arange(hi - lo), n)[order]
                first = np.flatnonzero(np.diff(token, prepend=token[:1] ^ np.uint64(1)))
                count = np.diff(first, append=len(token))
                several = np.repeat(count > 1, count)
                rows.append((batch % parts, batch, _LOCAL, None, pack(token[several]),
                             planes(doc[several], 4), None))
                own, ref = token[first], doc[first]
                part = own >> shift
                cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(own)]
                for at, end in zip(cuts, cuts[1:] if len(own) else []):
                    s = slice(at, end)
                    rows.append((int(part[at]), batch, _TOKENS, None, pack(own[s]), planes(count[s], 4),
                                 planes(ref[s], 4)))
                yield _table(rows)
                batch += 1
    return run


def _answers(t: pa.Table) -> pa.Table:
    """One part: what is asked for tokens becomes, batch by batch, the tokens that
    two or more documents have, with frequency code and document; the other
    rows pass."""
    asked = np.flatnonzero(t.column("kind").to_numpy() == _TOKENS)
    passed = t.take(pa.array(np.flatnonzero(t.column("kind").to_numpy() != _TOKENS)))
    if not len(asked):
        return passed
    rows = t.take(pa.array(asked))
    token = [unpack(x) for x in rows.column("x").to_pylist()]
    count = [numbers(x, 4) for x in rows.column("y").to_pylist()]
    ends = np.cumsum([len(x) for x in token])
    _, at = np.unique(np.concatenate(token), return_inverse=True)
    docs = np.bincount(at, weights=np.concatenate(count))[at]
    code = np.minimum(255, np.floor(8 * np.log2(docs))).astype(np.uint8)
    out = []
    for i, (batch, z) in enumerate(zip(rows.column("batch").to_pylist(),
                                       rows.column("z").to_pylist())):
        s = slice(ends[i] - len(token[i]), ends[i])
        keep = docs[s] > 1
        if keep.any():
            ref = np.where(count[i] > 1, np.uint64(_NO_REF), numbers(z, 4))
            out.append((0, batch, _TOKENS, None, pack(token[i][keep]), code[s][keep].tobytes(),
                        planes(ref[keep], 4)))
    if not out:
        return passed
    return pa.concat_tables([passed, pa.Table.from_batches([_table(out)]).cast(passed.schema)])


# ---- 2: prefixes -----------------------------------------------------------------

_GRAM = ("doc_id long, n long, own long, cls long, prefix binary, tokens binary, bins binary")


def _prefixes(percent: int):
    def run(t: pa.Table) -> pa.Table:
        """All rows of one batch -> its documents; those that can have a partner
        with their prefix, shared tokens and bins."""
        kind = t.column("kind").to_numpy()
        cols = {k: t.column(k).to_pylist() for k in ("ids", "x", "y", "z")}
        head, local = int(np.flatnonzero(kind == _DOCS)[0]), int(np.flatnonzero(kind == _LOCAL)[0])
        ids = cols["ids"][head]
        n, cls = (np.frombuffer(cols[k][head], "<i8") for k in "xy")
        token, code, ref = ([np.zeros(0, d)] for d in (np.uint64, np.uint8, np.uint64))
        for i in np.flatnonzero(kind == _TOKENS).tolist():
            token.append(unpack(cols["x"][i]))
            code.append(np.frombuffer(cols["y"][i], np.uint8))
            ref.append(numbers(cols["z"][i], 4))
        token, code, ref = (np.concatenate(x) for x in (token, code, ref))
        order = np.argsort(token)
        mine, ref_mine = unpack(cols["x"][local]), numbers(cols["y"][local], 4)
        code_mine = code[order][np.searchsorted(token, mine, sorter=order)] if len(mine) else code[:0]
        one = ref != _NO_REF
        token, code = np.concatenate([token[one], mine]), np.concatenate([code[one], code_mine])
        ref = np.concatenate([ref[one], ref_mine]).astype(np.int64)
        order = np.lexsort((token, code, ref))
        token, ref = token[order], ref[order]
        shared = np.bincount(ref, minlength=len(n))
        first, own = np.cumsum(shared) - shared, n - shared
        size = n - (percent * n + 99) // 100 + 1 - own
        out: list[tuple] = []
        for d, doc_id in enumerate(ids):
            if size[d] <= 0 or not n[d] or doc_id is None:
                out.append((doc_id, int(n[d]), None, None, None, None, None))
                continue
            x = token[first[d]:first[d] + shared[d]]
            bins = np.bincount((x % np.uint64(BINS)).astype(np.int64), minlength=BINS)
            out.append((doc_id, int(n[d]), int(own[d]), int(cls[d]),
                        x[:size[d]].astype("<u8").tobytes(), pack(np.sort(x)),
                        np.minimum(bins, 65535).astype("<u2").tobytes()))
        types = [pa.int64()] * 4 + [pa.binary()] * 3
        names = [f.split()[0] for f in _GRAM.split(", ")]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), types)], names=names)
    return run


def grams(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row a document: doc_id, n and, if its prefix holds a shared token, own
    (tokens that no other document has), cls, prefix, tokens, bins."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    # A word of this kind of text has some five characters with its blank.
    parts = 1 << max(0, min(32, int(chars // 5 // PART_TOKENS).bit_length()))
    answers = (texts.mapInArrow(_requests(parts), _ROW).groupBy("part").applyInArrow(_answers, _ROW))
    return stored(answers.groupBy("batch").applyInArrow(_prefixes(percent), _GRAM), "grams")


# ---- 3: filters and verification ---------------------------------------------------

def needed(n, m, percent: int):
    """Least size of the intersection of linked sets of n and m tokens."""
    return (percent * (n + m) + 99 + percent) // (100 + percent)


def _passes(percent: int, a: str, b: str):
    """Length and positional filter of two postings, as a condition."""
    n, m = f"{a}.n", f"{b}.n"
    rest = f"least({n} - {a}.pos, {m} - {b}.pos)"
    return F.expr(f"100 * least({n}, {m}) >= {percent} * greatest({n}, {m}) and {rest} * "
                  f"{100 + percent} >= {percent} * ({n} + {m})")


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes -> (token, cls, n, own, pos) of each prefix token."""
    for b in batches:
        cls, n, own = (b.column(i).to_numpy() for i in range(3))
        parts = [np.frombuffer(x.as_buffer(), "<i8") for x in b.column(3)]
        k = np.array([len(x) for x in parts], np.int64)
        if not k.sum():
            continue
        place = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        own_k = np.repeat(own, k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(parts)), *(pa.array(np.repeat(x, k)) for x in (cls, n)),
             pa.array(own_k), pa.array(own_k + place)], ["token", "cls", "n", "own", "pos"])


def _verify(percent: int):
    """Rows (a, b, then n, own, bins, tokens of either) -> linked pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, own, m, other = (batch.column(i).to_numpy() for i in (2, 3, 6, 7))
            bins = [np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2")
                    .reshape(-1, BINS).astype(np.int32) for i in (4, 8)]
            apart = np.abs(bins[0] - bins[1]).sum(1) + own + other
            least = needed(n, m, percent)
            good = apart <= n + m - 2 * least
            for i in np.flatnonzero(good):
                z = np.sort(np.concatenate([unpack(batch.column(5)[i].as_buffer()),
                                            unpack(batch.column(9)[i].as_buffer())]))
                good[i] = (z[1:] == z[:-1]).sum() >= least[i]
            yield batch.select([0, 1]).filter(pa.array(good))
    return run


_BLOCK_NAMES = ["cs", "ls", "ns", "os", "bins", "ks", "ts"]
_BLOCK_TYPE = ("block long, lo long, hi long, least long, most long, "
               + ", ".join(f"{c} binary" for c in _BLOCK_NAMES))


def _pack_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cls, label, n, own, bins, tokens) in order -> blocks."""
    def flush(rows):
        cls, label, n, own, bins, tokens = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([x]) for x in (min(cls), min(label), max(label), min(n), max(n))]
            + [pa.array([np.array(x, "<i8").tobytes()], pa.binary()) for x in (cls, label, n, own)]
            + [pa.array([b"".join(bins)], pa.binary()),
               pa.array([np.array([len(t) // BYTES for t in tokens], "<i8").tobytes()], pa.binary()),
               pa.array([b"".join(tokens)], pa.binary())],
            ["block", "lo", "hi", "least", "most", *_BLOCK_NAMES])

    rows, size = [], 0
    for b in batches:
        for row in zip(*(b.column(i).to_pylist() for i in range(6))):
            k = len(row[5]) // BYTES
            if rows and (len(rows) == BLOCK or size + k > BLOCK_TOKENS):
                yield flush(rows)
                rows, size = [], 0
            rows.append(row)
            size += k
    if rows:
        yield flush(rows)


class _Block:
    def __init__(self, cs, ls, ns, os, bins, ks, ts):
        self.cls, self.label, self.n, self.own, self.k = (
            np.frombuffer(x.as_buffer(), "<i8") for x in (cs, ls, ns, os, ks))
        self.bins = np.frombuffer(bins.as_buffer(), "<u2").reshape(-1, BINS).astype(np.int32)
        self.raw, self.end = ts.as_buffer(), np.cumsum(self.k) * BYTES
        self.sets: dict[int, np.ndarray] = {}

    def set_of(self, i: int) -> np.ndarray:
        if i not in self.sets:
            self.sets[i] = unpack(self.raw[int(self.end[i] - self.k[i] * BYTES):int(self.end[i])])
        return self.sets[i]


def _block_links(percent: int):
    """Pairs of blocks -> links that join different components of the pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in zip(*b.columns):
                x, y = _Block(*row[:7]), _Block(*row[7:])
                least = needed(x.n[:, None], y.n[None, :], percent)
                room = x.n[:, None] + y.n[None, :] - 2 * least - x.own[:, None] - y.own[None, :]
                ok = ((x.label[:, None] != y.label[None, :]) & (room >= 0)
                      & (100 * np.minimum(x.n[:, None], y.n[None, :])
                         >= percent * np.maximum(x.n[:, None], y.n[None, :])))
                if x.cls[0] == y.cls[0]:
                    ok = np.triu(ok)
                i, j = np.nonzero(ok)
                for lo in range(0, len(i), 1 << 14):
                    s = slice(lo, lo + (1 << 14))
                    apart = np.abs(x.bins[i[s]] - y.bins[j[s]]).sum(1)
                    ok[i[s], j[s]] = apart <= room[i[s], j[s]]
                up: dict[int, int] = {}

                def top(v):
                    while up.get(v, v) != v:
                        v = up[v]
                    return v
                out = []
                for p, q in zip(*(k.tolist() for k in np.nonzero(ok))):
                    a, z = top(int(x.label[p])), top(int(y.label[q]))
                    if a == z:
                        continue
                    both = np.sort(np.concatenate([x.set_of(p), y.set_of(q)]), kind="stable")
                    if (both[1:] == both[:-1]).sum() >= least[p, q]:
                        up[max(a, z)] = min(a, z)
                        out.append((int(x.cls[p]), int(y.cls[q])))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*out)], ["a", "b"])
    return run


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for block, cs in zip(b.column(0).to_pylist(), b.column(1)):
            own = np.frombuffer(cs.as_buffer(), "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), block)), pa.array(own)],
                                             ["block", "cls"])


def _linked(pairs: DataFrame, classes: DataFrame, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) of classes that are linked; each is verified once."""
    def side(key: str) -> DataFrame:
        return classes.select(F.col("cls").alias(key), *[F.col(c).alias(f"{key}_{c}")
                                                         for c in ("n", "own", "bins", "tokens")])
    cols = [f"{k}_{c}" for k in "ab" for c in ("n", "own", "bins", "tokens")]
    return stored(pairs.distinct().join(side("b"), "b").join(side("a"), "a").select("a", "b", *cols)
                  .mapInArrow(_verify(percent), "a long, b long"), f"{name}-links")


def _block_pairs(at: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links across components within the long open lists ``at`` (token, cls, label)."""
    member = at.groupBy("cls").agg(F.first("label").alias("label"))
    tasks = max(1, -(-member.count() // (4 * BLOCK)))
    blocks = stored(member.join(classes, "cls").repartitionByRange("label", "n", "cls").coalesce(tasks)
                    .sortWithinPartitions("label", "n", "cls")
                    .select("cls", "label", "n", "own", "bins", "tokens")
                    .mapInArrow(_pack_blocks, _BLOCK_TYPE), "gram-blocks")
    of = blocks.select("block", "cs").mapInArrow(_members, "block long, cls long")
    main = (at.groupBy("token", "label").agg(F.count("*").alias("m"))
            .groupBy("token").agg(F.max_by("label", F.struct("m", "label")).alias("main")))
    info = blocks.select("block", "lo", "hi", "least", "most")
    spots = (at.select("token", "cls").join(of, "cls").select("token", "block").distinct()
             .join(main, "token").join(info, "block")
             .withColumn("pure", F.expr("lo = hi and lo = main")))
    spots = stored(spots.select("token", "block", "pure", "least", "most", "lo", "hi"), "spots")
    x, y = spots.where("not pure").alias("x"), spots.alias("y")
    pairs = (x.join(y, F.col("x.token") == F.col("y.token"))
             # Blocks of one and the same component, or of too different sizes.
             .where("not (x.lo = x.hi and y.lo = y.hi and x.lo = y.lo)")
             .where(f"100 * x.most >= {percent} * y.least and 100 * y.most >= {percent} * x.least")
             .select(F.least("x.block", "y.block").alias("x"), F.greatest("x.block", "y.block").alias("y"))
             .distinct())

    def load(name: str) -> DataFrame:
        return blocks.select(F.col("block").alias(name),
                             *[F.col(c).alias(f"{name}_{c}") for c in _BLOCK_NAMES])
    loaded = pairs.join(load("y"), "y").join(load("x"), "x")
    return stored(loaded.select(*[f"{k}_{c}" for k in "xy" for c in _BLOCK_NAMES])
                  .mapInArrow(_block_links(percent), "a long, b long"), "block-links")


def class_components(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(rows, labels): the ``grams`` rows, and (id, label) of each linked class."""
    rows = grams(docs, percent)
    classes = stored(rows.where("cls is not null").groupBy("cls").agg(
        F.first(F.struct("n", "own", "prefix", "tokens", "bins")).alias("r"))
        .select("cls", "r.*"), "gram-classes")
    posts = classes.select("cls", "n", "own", "prefix").mapInArrow(
        _postings, "token long, cls long, n long, own long, pos long")
    score = F.struct(F.floor(1000 * F.col("own") / F.col("n")).alias("score"), "cls", "n", "pos")
    # Tables on the small side of these joins: a skewed list can then be split.
    heads = stored(posts.groupBy("token").agg(F.count("*").alias("m"), F.min(score).alias("hub"))
                   .where("m > 1"), "list-heads")
    live = stored(posts.join(heads, "token"), "lists")
    star = (live.alias("p").where(F.col("p.cls") != F.col("p.hub.cls"))
            .where(_passes(percent, "p", "p.hub"))
            .select(F.col("hub.cls").alias("a"), F.col("cls").alias("b")))
    labels = components(_linked(star, classes, percent, "hub"), "hub")

    at = (live.join(labels.withColumnRenamed("id", "cls"), "cls", "left")
          .withColumn("label", F.coalesce("label", "cls")))
    open_ = stored(at.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
                   .where("lo <> hi").select("token"), "open")
    at = stored(at.join(open_, "token").select("token", "cls", "label", "n", "pos", "m"), "open-lists")
    small = at.where(F.col("m") <= SMALL)
    across = (small.alias("x").join(small.alias("y"), F.col("x.token") == F.col("y.token"))
              .where("x.cls < y.cls and x.label <> y.label").where(_passes(percent, "x", "y"))
              .select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")))
    links = _linked(across, classes, percent, "small").unionByName(
        _block_pairs(at.where(F.col("m") > SMALL), classes, percent))

    def label(key: str) -> DataFrame:
        return labels.select(F.col("id").alias(key), F.col("label").alias(f"l{key}"))
    edges = stored(links.join(label("a"), "a", "left").join(label("b"), "b", "left")
                   .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
                   .where("a <> b").distinct(), "rest-edges")
    if edges.take(1):
        # Components of components; ends that no hub had reached are new ids.
        up = components(edges, "rest").select(F.col("id").alias("label"), F.col("label").alias("top"))
        ends = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
        old = labels.unionByName(ends.join(labels, "id", "left_anti")
                                 .select("id", F.col("id").alias("label")))
        labels = stored(old.join(up, "label", "left")
                        .select("id", F.coalesce("top", "label").alias("label")), "labels")
    return rows, labels


def jaccard_join(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.  Documents
    are linked if 100 * intersection >= ``percent`` * union of their sets."""
    rows, labels = class_components(docs, percent)
    classes = (rows.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("low"))
               .join(labels.withColumnRenamed("id", "cls"), "cls", "left")
               .select("cls", "low", F.coalesce("label", "cls").alias("label")))
    names = classes.groupBy("label").agg(F.min("low").alias("component_id"))
    of = classes.join(names, "label").select("cls", "component_id")
    return rows.join(of, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(read(spark, sf_dir, "documents"))


#: DuckDB twin: shingles of whole texts, links through an inverted index,
#: components by walking links from every document.
NGRAM_JOIN_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
           lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE
           WHEN len(ws) = 0 THEN CAST([] AS UBIGINT[])
           WHEN len(ws) < 4 THEN [hash(array_to_string(ws, ' '))]
           ELSE list_transform(range(1, len(ws) - 2),
                               lambda i: hash(array_to_string(ws[i:i + 3], ' '))) END) AS sh
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
SELECT n.doc_id, n.n_shingles, coalesce(comp.low, n.doc_id) AS component_id
FROM n LEFT JOIN cls ON n.doc_id = cls.doc_id LEFT JOIN rep ON cls.c = rep.c
LEFT JOIN comp ON comp.a = rep.doc_id
"""

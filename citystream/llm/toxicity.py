"""Toxicity by a subsequence string kernel and a support vector machine.

The kernel compares words by their common subsequences of three letters, each
occurrence weighted ``DECAY`` ** (letters it spans), spans up to ``SPAN``; so
letters put inside an insult cost a little and do not hide it.  A word is its
letters only (word ends count as letters): dots, stars, digits, blanks, dashes,
quotes or zero-width marks, ASCII or not, set between letters fall away before,
and runs of single letters are joined.
Occurrence weights are divided by a norm that depends on the word's length
alone, so the kernel stays positive semi-definite.

Training takes at most ``TRAIN_ROWS`` labelled documents of each class, by hash
order; what it needs of them is counted by Spark, so no text and no vocabulary
reaches the driver.  Each distinct word (words over ``LONG`` letters through
overlapping windows) gets the number of toxic and clean documents that hold it;
subsequences get smoothed log odds over those words.  Words of toxic documents
that clean ones do not have are scored by them; the best ``BAG`` of each bag and
the closest, commonest and some other clean words give the instances and, by
frequency, the Nystroem landmarks.  On these bounded rows one task fits a linear
SVM (squared hinge, Newton steps) over Nystroem features, refitted with each
toxic bag's highest word as its witness (multiple-instance learning).  The
landmark expansion is then collapsed: sum_l a_l k(w, l) is one weight for each
three-letter subsequence, so a word costs a table lookup for each of its
subsequences, whatever the number of landmarks.

A document's score is the logistic of its highest word, fitted on the same
sample with its length as a second feature.  Whole texts are scored; all work
is array operations on a batch.

Defined results: null or letterless text scores the prior of an empty text
(logistic of the lowest word), never null; repeated rows score alike; null
labels do not train; with no toxic or no clean training row the score is the
constant share of toxic rows (0 if there are no labels at all).
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citystream.llm.bpe import slices
from citystream.llm.common import mix64, read, small_batches, stored, trimmed

#: Most labelled rows of each class that the model is fitted on (hash order).
TRAIN_ROWS = 2000
#: Instances of each toxic document; clean words by score, frequency, hash.
BAG, CLEAN = 8, (6000, 4000, 4000)
#: Nystroem landmarks: toxic witnesses, clean words.
LANDMARKS = (160, 96)
DECAY, SPAN = 0.6, 5
#: Weight of all witnesses together, as a share of that of the clean words.
POSITIVE = 0.3
RIDGE = 3.0
#: predicted = 1 from this score on.
THRESHOLD = 0.7
#: Letters: a-z, Latin-1 continuation letters, begin and end of a word.
BEGIN, END, SIGMA = 59, 60, 61
LONG = 24

_LETTER = np.zeros(256, np.uint8)
_LETTER[97:123] = np.arange(1, 27)
_LETTER[0x80:0xC0] = 27 + (np.arange(0x80, 0xC0) & 0x1F)
_POWER = np.uint64(0x9E3779B97F4A7C15)
_MARK = re.compile(r"[^\w\x00-\x7F]+")
#: Weights of subsequences are summed as integers of this grain, so that sums do
#: not depend on the order of the tasks.
GRAIN = 1 << 20


def _plain(text: str) -> str:
    """Marks beyond ASCII fall away, blanks beyond ASCII become blanks."""
    if text.isascii():
        return text
    return _MARK.sub(lambda m: " " if any(c.isspace() for c in m.group()) else "", text)


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters, word start in letters, text of each word) of lower-cased
    texts; a word is a run without ASCII white space, letters only; words of
    one letter join with neighbours of one letter; letterless words vanish."""
    raw = [_plain(t).encode("utf-8", "surrogatepass") for t in texts]
    starts = np.cumsum([0] + [len(r) + 1 for r in raw[:-1]]) if raw else np.zeros(0, np.int64)
    b = np.frombuffer(b"\n".join(raw).lower(), np.uint8)
    code = _LETTER[b]
    # Word number of every byte: grows behind white space.
    space = (b == 32) | ((b >= 9) & (b <= 13))
    at = np.flatnonzero(code)
    if not len(at):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    number = np.cumsum(space)[at]
    first = np.flatnonzero(np.diff(number, prepend=-1))
    lens = np.diff(np.append(first, len(at)))
    doc = np.searchsorted(starts, at[first], "right") - 1
    single = lens == 1
    join = np.zeros(len(first), bool)
    join[1:] = single[1:] & single[:-1] & (doc[1:] == doc[:-1])
    first, doc = first[~join], doc[~join]
    return code[at], first, doc


def distinct(letters: np.ndarray, first: np.ndarray):
    """Padded letter matrix of the distinct words, row of each word, further
    rows (and their owners) of long words, hash of each distinct word."""
    lens = np.diff(np.append(first, len(letters)))
    # Longer words are seen through overlapping windows (rows of the matrix).
    pos = np.arange(len(letters)) - np.repeat(first, lens)
    power = np.cumprod(np.full(int(lens.max()), _POWER))
    h = np.add.reduceat(mix64(letters) * power[pos], first) + mix64(lens)
    h, row, word = np.unique(h, return_index=True, return_inverse=True)
    n = lens[row]
    m = np.full((len(row), LONG + 2), 0, np.uint8)
    m[:, 0] = BEGIN
    take = np.minimum(n, LONG)
    col = np.arange(int(take.sum())) - np.repeat(np.cumsum(take) - take, take)
    m[np.repeat(np.arange(len(row)), take), col + 1] = letters[np.repeat(first[row], take) + col]
    short = n <= LONG
    m[np.flatnonzero(short), n[short] + 1] = END
    extra, owner = [], []
    for i in np.flatnonzero(~short):
        for lo in range(LONG // 2, int(n[i]), LONG // 2):
            piece = letters[first[row[i]] + lo:first[row[i]] + min(lo + LONG, n[i])]
            line = np.zeros(LONG + 2, np.uint8)
            line[1:1 + len(piece)] = piece
            if lo + LONG >= n[i]:
                line[1 + len(piece)] = END
            extra.append(line)
            owner.append(i)
    return (m, word, (np.array(extra, np.uint8).reshape(-1, LONG + 2),
                      np.array(owner, np.int64)), h)


def _spans():
    for d in range(2, SPAN):
        for mid in range(1, d):
            yield mid, d


def occurrences(m: np.ndarray):
    """Subsequence codes of a letter matrix, one (codes, weight) a shape."""
    wide = m.astype(np.int32)
    for mid, d in _spans():
        a, b, c = wide[:, :-d], wide[:, mid:wide.shape[1] - d + mid], wide[:, d:]
        yield np.where(c > 0, (a * SIGMA + b) * SIGMA + c, 0), DECAY ** (d + 1)


def norms(m: np.ndarray) -> np.ndarray:
    """Length-only norm of each row: root of the summed squared weights."""
    n = (m > 0).sum(1)
    total = np.zeros(len(m))
    for _, d in _spans():
        total += np.maximum(n - d, 0) * DECAY ** (2 * (d + 1))
    return np.sqrt(np.maximum(total, DECAY ** 6))


def apply(table: np.ndarray, m: np.ndarray) -> np.ndarray:
    """sum over subsequences of weight * table, divided by the norm."""
    width = max(4, int((m > 0).sum(1).max())) if len(m) else 4
    m = m[:, :width]
    out = np.zeros(len(m), np.float32)
    for codes, weight in occurrences(m):
        out += np.float32(weight) * table[codes].sum(1)
    return out / norms(m)


def kernel(m: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """k(row, landmark) for all pairs."""
    out = np.zeros((len(m), len(landmarks)))
    for j in range(len(landmarks)):
        out[:, j] = apply(_spread(landmarks[j:j + 1], np.ones(1)), m)
    return out


def _spread(m: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Table over subsequences of sum_i weight_i * phi(row_i)."""
    table = np.zeros(SIGMA ** 3)
    scaled = weight / norms(m)
    for codes, w in occurrences(m):
        np.add.at(table, codes.ravel(), np.repeat(w * scaled, codes.shape[1]))
    table[0] = 0
    return table.astype(np.float32)


def _svm(z: np.ndarray, rows: np.ndarray, y: np.ndarray, c: np.ndarray, ridge: float = RIDGE):
    """Squared-hinge linear SVM on rows of z, by Newton steps on its support vectors."""
    k = z.shape[1]
    w = np.zeros(k + 1)
    reg = ridge * np.eye(k + 1)
    reg[-1, -1] = 1e-6
    for _ in range(25):
        on = np.flatnonzero(y * ((z @ w[:k])[rows] + w[k]) < 1)
        h, g = reg.copy(), np.zeros(k + 1)
        # Sums over the support vectors, some at a time: no copy of all of them.
        for lo in range(0, len(on), 2048):
            i = on[lo:lo + 2048]
            x = np.hstack([z[rows[i]], np.ones((len(i), 1))])
            xs = x * c[i, None]
            h += xs.T @ x
            g += xs.T @ y[i]
        new = np.linalg.solve(h, g)
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w[:-1], w[-1]


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + 1e-2 * w
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


# ---- training: counts by Spark, one bounded fit ---------------------------------

def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, toxic, text -> (doc, toxic, word, line) of each distinct word of each
    text; a long word gives its windows."""
    for b in batches:
        texts = b.column(2).to_pylist()
        for lo, hi in slices(texts, 1_000_000):
            letters, first, doc = words(texts[lo:hi])
            if not len(first):
                continue
            m, word, (extra, owner), _ = distinct(letters, first)
            pair = np.unique(word.astype(np.int64) * (hi - lo) + doc)
            line, of = pair // (hi - lo), pair % (hi - lo)
            if len(owner):
                at = np.searchsorted(line, owner), np.searchsorted(line, owner, "right")
                times = at[1] - at[0]
                row = np.repeat(np.arange(len(owner)), times)
                pick = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                line = np.concatenate([line, len(m) + row])
                of = np.concatenate([of, of[np.repeat(at[0], times) + pick]])
                m = np.concatenate([m, extra])
            power = np.cumprod(np.full(m.shape[1], _POWER))
            name = mix64((mix64(m.astype(np.uint64)) * power).sum(1)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(lo, hi - lo).take(pa.array(of)),
                 b.column(1).slice(lo, hi - lo).take(pa.array(of)), pa.array(name[line]),
                 pa.array([x.tobytes() for x in m[line]], pa.binary())],
                ["doc", "toxic", "word", "line"])


def _lines(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(-1, LONG + 2)


def _weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """line, only, weight -> (code, toxic, clean): summed weights of subsequences."""
    total = np.zeros((2, SIGMA ** 3), np.int64)
    for b in batches:
        m, only, weight = _lines(b.column(0)), *(
            b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
        scaled = weight / norms(m)
        for codes, w in occurrences(m):
            part = np.rint(GRAIN * w * scaled).astype(np.int64)
            for kind in (0, 1):
                own = only == (kind == 0)
                np.add.at(total[kind], codes[own].ravel(), np.repeat(part[own], codes.shape[1]))
    total[:, 0] = 0
    at = np.flatnonzero(total.any(0))
    for lo in range(0, len(at), 50_000):
        some = at[lo:lo + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some, *total[:, some])],
                                         ["code", "toxic", "clean"])


def _first_scores(odds):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(odds.value, np.float32)
        for b in batches:
            s = apply(table, _lines(b.column("line"))) + 0.5 * np.log1p(b.column("bad").to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())],
                                             [*b.schema.names, "score"])
    return run


def _fit(bags: pa.Table, clean: pa.Table, n_bad: int, n_good: int) -> tuple | None:
    """(table, bias) of the collapsed SVM, from the best words of the toxic bags
    (doc, word, line, bad, good, score) and clean words (word, line, score)."""
    if not bags.num_rows or not clean.num_rows:
        return None
    names, at, bag_row = np.unique(bags["word"].to_numpy(), return_index=True, return_inverse=True)
    bad, good, first_score = (bags[c].to_numpy()[at] for c in ("bad", "good", "score"))
    m, cw = (_lines(t["line"].combine_chunks()) for t in (bags, clean))
    m = m[at]
    order = np.lexsort((names[bag_row], bags["doc"].to_numpy()))
    bag_row, doc = bag_row[order], bags["doc"].to_numpy()[order]
    top_score = max(np.abs(first_score).max(), np.abs(clean["score"].to_numpy()).max()) + 1e-9
    pos = np.argsort(-(bad + first_score / top_score), kind="stable")[:LANDMARKS[0]]
    neg = np.argsort(mix64(clean["word"].to_numpy().view(np.uint64) + np.uint64(7)),
                     kind="stable")[:LANDMARKS[1]]
    marks = np.concatenate([m[pos], cw[neg]])
    kmm = kernel(marks, marks)
    val, vec = np.linalg.eigh((kmm + kmm.T) / 2)
    use = val > 1e-6 * val.max()
    proj = vec[:, use] / np.sqrt(val[use])
    every = np.concatenate([m, cw])
    z = np.concatenate([kernel(every[lo:lo + 2048], marks) @ proj
                        for lo in range(0, len(every), 2048)])
    begins = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    score, w, b = first_score, None, None
    odds_of = np.log((bad + 0.5) / n_bad * n_good / (good + 0.5))
    for round_ in range(6):
        s = score[bag_row]
        best = np.repeat(np.maximum.reduceat(s, begins), np.diff(np.append(begins, len(s))))
        # From the third round on a bag without any word above 0 is taken for
        # mislabelled and has no witness.
        is_top = (s >= best) & ((best > 0) | (round_ < 2))
        if not is_top.any():
            break
        times = np.bincount(bag_row[is_top], minlength=len(m))
        witness = np.flatnonzero(times)
        rows = np.concatenate([witness, np.arange(len(m), len(m) + len(cw))])
        y = np.where(rows < len(m), 1.0, -1.0)
        c = np.ones(len(rows))
        # A word seen once says little; one that recurs in toxic bags much.
        c[:len(witness)] = np.minimum(times[witness], 20) * np.maximum(odds_of[witness], 0.1)
        c[:len(witness)] *= POSITIVE * len(cw) / c[:len(witness)].sum()
        w, b = _svm(z, rows, y, c)
        score = z[:len(m)] @ w + b
    return None if w is None else (_spread(marks, proj @ w), float(b))


def _fit_task(n_bad: int, n_good: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All instances, bounded by BAG, CLEAN and TRAIN_ROWS -> the fit."""
        got = list(batches)
        if got:
            t = pa.Table.from_batches(got).sort_by([("doc", "ascending"), ("word", "ascending")])
            fit_ = _fit(t.filter(pc.invert(t["clean"])), t.filter(t["clean"]), n_bad, n_good)
            if fit_:
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit_)], pa.binary())],
                                                 ["fit"])
    return run


def _best_words(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(model.value)
        for b in batches:
            texts = b.column(2).to_pylist()
            for lo, hi in slices(texts, 1_000_000):
                best, count = _document_scores(own, texts[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo),
                     pa.array(best), pa.array(count)], ["doc", "toxic", "best", "count"])
    return run


def fit(rows: DataFrame, n_bad: int, n_good: int) -> dict:
    """Model from labelled rows (doc, toxic, text); ``n_bad`` toxic, ``n_good``
    clean ones.  ``prior`` is the share of toxic rows."""
    spark = rows.sparkSession
    small_batches(spark)
    nothing = {"table": None, "prior": n_bad / max(1, n_bad + n_good)}
    if not n_bad or not n_good:
        return nothing
    bags = stored(rows.mapInArrow(trimmed(_bags), "doc long, toxic int, word long, line binary"), "bags")
    # Labels can be wrong: a word counts as toxic only if it is five times as
    # frequent in toxic documents, not only if clean ones never have it.
    vocabulary = stored(
        bags.groupBy("word").agg(F.min("line").alias("line"), F.sum("toxic").alias("bad"),
                                 F.sum(1 - F.col("toxic")).alias("good"))
        .withColumn("only", F.expr(f"bad > 0 and (bad + 0.5D) / {n_bad} > 5 * (good + 0.5D) / {n_good}")),
        "vocabulary")
    odds = np.zeros((2, SIGMA ** 3))
    parts = (vocabulary.select("line", "only", F.when(F.col("only"), F.sqrt("bad"))
                               .otherwise(F.sqrt(F.least("good", F.lit(3)))).alias("weight"))
             .mapInArrow(_weights, "code long, toxic long, clean long")
             .groupBy("code").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
             .toArrow())  # at most SIGMA ** 3 rows
    odds[:, parts["code"].to_numpy()] = [parts["toxic"].to_numpy(), parts["clean"].to_numpy()]
    odds = odds / GRAIN + 1e-3
    odds = np.log(odds[0] / odds[0].sum()) - np.log(odds[1] / odds[1].sum())
    odds[0] = 0
    shipped = spark.sparkContext.broadcast(odds.astype(np.float32).tobytes())
    scored = stored(vocabulary.mapInArrow(
        _first_scores(shipped), "word long, line binary, bad long, good long, only boolean, "
        "score double"), "scored-words")
    # Instances: the best words of each toxic bag, clean words of three kinds.
    rank = Window.partitionBy("doc").orderBy(F.desc("score"), "word")
    best = (bags.where("toxic = 1").select("doc", "word").distinct()
            .join(scored.where("only"), "word").withColumn("i", F.row_number().over(rank))
            .where(F.col("i") <= BAG).select("doc", "word", "line", "bad", "good", "score"))
    clean = scored.where("not only")
    kinds = (F.desc("score"), F.desc("good"), F.xxhash64("word"))
    some = [clean.orderBy(k, "word").limit(n) for k, n in zip(kinds, CLEAN)]
    others = some[0].union(some[1]).union(some[2]).dropDuplicates(["word"]).select(
        F.lit(None).cast("long").alias("doc"), "word", "line", "bad", "good", "score")
    instances = stored(best.withColumn("clean", F.lit(False)).unionByName(
        others.withColumn("clean", F.lit(True))), "instances")
    got = instances.coalesce(1).mapInArrow(trimmed(_fit_task(n_bad, n_good)), "fit binary").collect()
    if not got:
        return nothing
    table, bias = pickle.loads(got[0]["fit"])
    model = {"table": table, "bias": bias, "prior": nothing["prior"]}
    seen = (rows.mapInArrow(_best_words(spark.sparkContext.broadcast(pickle.dumps(model))),
                            "doc long, toxic int, best double, count long")
            .toArrow().sort_by([("doc", "ascending"), ("best", "ascending"), ("count", "ascending")]))
    best, count = seen["best"].to_numpy(), seen["count"].to_numpy()
    has = np.isfinite(best)
    model["low"] = float(best[has].min()) if has.any() else -1.0
    best = np.where(has, best, model["low"])
    model["logit"] = _logistic(np.column_stack([best, np.log1p(count)]),
                               seen["toxic"].to_numpy().astype(float))
    return model


def _document_scores(model: dict, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(highest word score, number of words) of each text."""
    best = np.full(len(texts), -np.inf)
    letters, first, doc = words(texts)
    if len(first):
        m, word, (extra, owner), _ = distinct(letters, first)
        f = np.concatenate([apply(model["table"], m[lo:lo + 16384])
                            for lo in range(0, len(m), 16384)]) + model["bias"]
        if len(owner):
            np.maximum.at(f, owner, apply(model["table"], extra) + model["bias"])
        start = np.flatnonzero(np.diff(doc, prepend=-1))
        best[doc[start]] = np.maximum.reduceat(f[word], start)
    return best, np.bincount(doc, minlength=len(texts))


def score(model: dict, texts: list[str]) -> np.ndarray:
    """Probability-like score in 0..1 of each text."""
    if model["table"] is None:
        return np.full(len(texts), model["prior"])
    best, count = _document_scores(model, texts)
    best = np.where(np.isfinite(best), best, model["low"])
    x = np.column_stack([best, np.log1p(count), np.ones(len(texts))]) @ model["logit"]
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS,
          where: str = "true") -> dict:
    """Fit on at most ``rows`` labelled documents of each class, the first by a
    hash of doc_id among those that ``where`` admits."""
    known = (labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
             .where("doc_id is not null and toxic in (0, 1)").where(where)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n:
        return {"table": None, "prior": 0.0}
    picked = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
              for k in sorted(n)]
    chosen = picked[0] if len(picked) == 1 else picked[0].union(picked[1])
    # At most 2 * rows of these narrow rows: they go to the scan, no text is shuffled.
    texts = stored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                   .where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
                   .select(F.col("doc_id").alias("doc"), "toxic", "text"), "training-texts")
    have = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    model = fit(texts, have.get(1, 0), have.get(0, 0))
    model["prior"] = n.get(1, 0) / sum(n.values())
    return model


def _scorer(model, text: int, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(model.value)
        for b in batches:
            texts = [t or "" for t in b.column(text).to_pylist()]
            for lo, hi in slices(texts, 1_000_000):
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(lo, hi - lo) for c in b.columns),
                     pa.array(score(own, texts[lo:hi]), pa.float64())],
                    [*b.schema.names, out])
    return run


def score_documents(docs: DataFrame, model: dict, text: str = "text",
                    out: str = "toxicity") -> DataFrame:
    """``docs`` plus the score ``out`` (a column of that name is replaced).  The
    model (one weight for each subsequence, under 1 MB whatever the data) goes to
    every task."""
    small_batches(docs.sparkSession)
    docs = docs.drop(out)
    shipped = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(trimmed(_scorer(shipped, docs.columns.index(text), out)),
                           f"{fields}, `{out}` double")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held = "crc32(cast(doc_id as string)) % 3 = 1"
    model = train(docs, read(spark, sf_dir, "labels"), where=f"not ({held})")
    return (score_documents(docs, model)
            .select("doc_id", F.expr(held).alias("held_out"), F.col("toxicity").alias("score"),
                    (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted")))

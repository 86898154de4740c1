"""Language identification of mixed-language text.

Training counts hashed letter trigrams (word ends count as letters) and the
scripts of each language over *all* training texts, in Spark: tasks count into
dense arrays and emit sums, so the shuffle carries a bounded table per task.
Scoring, per document: every word (a maximal run of letters) gets one naive
Bayes log-likelihood per language; the script range of its first letter
narrows the candidates to languages that use that script; Viterbi over the
words with a penalty for each switch labels spans.  The document's language is
that with most letters in its spans.

Viterbi runs for a whole batch at once: texts are cut into chunks of ``CHUNK``
words, each chunk's best-path matrix (language in x language out) is found in
lockstep over all chunks, a short pass joins the chunks of each text, and a
second lockstep pass traces the paths back.  Memory is bounded by the batch;
no prefix is taken of long texts.

Defined results: null text, or text without letters -> ``und``, score 0;
words of a script that no language uses are left out of the vote unless there
are no others; ties go to the alphabetically first language; repeated rows
are labelled alike; an untrained model (no labelled row) says ``und``.
"""

from __future__ import annotations

import pickle
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.llm.bpe import slices
from citystream.llm.common import mix64, read, small_batches, trimmed

#: log2 of the number of trigram classes.
BITS = 18
#: Nats that a change of language costs.
PENALTY = 12.0
CHUNK = 64
#: A language uses a script if at least this share of its letters is in it.
SCRIPT_SHARE = 0.02
#: Languages a model can hold (its table has 1 MB for each); more are refused.
MAX_LANGUAGES = 300
UNKNOWN = "und"

#: First code points of Unicode script ranges and their scripts.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
    (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
    (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"),
    (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x31F0, "kana"),
    (0x3200, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB07, "other"),
    (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"), (0xFF00, "latin"),
    (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"),
    (0x32000, "other"),
]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})

_TABLES: dict[str, np.ndarray] = {}


def unicode_tables() -> dict[str, np.ndarray]:
    """Letter test, lower case and script of each code point (built once)."""
    if not _TABLES:
        n = 0x110000
        chars = [chr(i) for i in range(n)]
        _TABLES["letter"] = np.fromiter((unicodedata.category(c)[0] == "L" for c in chars), bool, n)
        low = np.arange(n, dtype=np.uint32)
        for i in np.flatnonzero(_TABLES["letter"]):
            c = chars[i].lower()
            if len(c) == 1:
                low[i] = ord(c)
        _TABLES["lower"] = low
        starts = np.array([s for s, _ in SCRIPTS])
        index = np.array([SCRIPT_NAMES.index(x) for _, x in SCRIPTS], np.int8)
        _TABLES["script"] = index[np.searchsorted(starts, np.arange(n), "right") - 1]
    return _TABLES


def words(texts: list[str]):
    """(trigram classes, first trigram, letters, script, text) of all words."""
    t = unicode_tables()
    raw = "\n".join(texts).encode("utf-32-le", "surrogatepass")
    cp = np.frombuffer(raw, np.uint32)
    ends = np.cumsum([len(x) + 1 for x in texts])
    inside = t["letter"][cp]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    at, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    lens = end - at
    # Letters with a 0 before and behind each word, in one array.
    low = t["lower"][cp[inside]].astype(np.uint64)
    pad = np.zeros(len(low) + 2 * len(at), np.uint64)
    first = np.cumsum(lens) - lens
    pad[np.arange(len(low)) + 2 * np.repeat(np.arange(len(at)), lens) + 1] = low
    with np.errstate(over="ignore"):
        code = (pad[:-2] * np.uint64(0x9E3779B97F4A7C15) + pad[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
                + pad[2:] * np.uint64(0x165667B19E3779F9)) if len(pad) > 2 else pad[:0]
    # One trigram for each letter: centred on it.
    centre = np.arange(len(low)) + 2 * np.repeat(np.arange(len(at)), lens)
    code = (mix64(code[centre]) >> np.uint64(64 - BITS)).astype(np.int32)
    return code, first, lens, t["script"][cp[at]], np.searchsorted(ends, at, "right")


# ---- training ---------------------------------------------------------------

def _counter(langs: list[str]):
    index = {x: i for i, x in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tri = np.zeros((len(langs), 1 << BITS), np.int64)
        script = np.zeros((len(langs), len(SCRIPT_NAMES)), np.int64)
        for b in batches:
            lang = np.fromiter((index[x] for x in b.column(0).to_pylist()), np.int64, b.num_rows)
            texts = b.column(1).to_pylist()
            for lo, hi in slices(texts):
                code, first, lens, of, doc = words(texts[lo:hi])
                if not len(first):
                    continue
                own = lang[lo:hi][doc]
                flat = np.repeat(own, lens).astype(np.int64) << BITS | code
                tri += np.bincount(flat, minlength=tri.size).reshape(tri.shape)
                script += np.bincount(own * script.shape[1] + of, weights=lens,
                                      minlength=script.size).astype(np.int64).reshape(script.shape)
        for kind, table in (("t", tri), ("s", script)):
            i, j = np.nonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(i)), pa.array(i.astype(np.int32)),
                 pa.array(j.astype(np.int32)), pa.array(table[i, j])],
                ["kind", "lang", "code", "n"])
    return run


def train(docs: DataFrame, where: str = "true") -> dict:
    """Model from all rows of ``docs`` (doc_id, text, lang) that ``where`` admits
    and that have text and lang.  The model has one weight for each language
    and trigram class; the number of languages bounds it, not the data."""
    small_batches(docs.sparkSession)
    known = (docs.where(where).select("lang", F.col("text").cast("string"))
             .where("lang is not null and text is not null and lang <> ''"))
    langs = sorted(r["lang"] for r in
                   known.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if not langs:
        return {"langs": []}
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} values of lang: not a column of languages")
    sums = (known.mapInArrow(trimmed(_counter(langs)), "kind string, lang int, code int, n long")
            .groupBy("kind", "lang", "code").agg(F.sum("n").alias("n")).toArrow())
    kind = np.array(sums.column("kind").to_pylist())
    lang, code, n = (sums.column(c).to_numpy() for c in ("lang", "code", "n"))
    tri = np.zeros((1 << BITS, len(langs)), np.float64)
    t = kind == "t"
    tri[code[t], lang[t]] = n[t]
    script = np.zeros((len(SCRIPT_NAMES), len(langs)))
    script[code[~t], lang[~t]] = n[~t]
    total = tri.sum(0)
    # Smoothing is a fixed share of each language's mass, so that a language
    # with few texts does not gain from what it has not seen.
    used = max(1, int((tri.sum(1) > 0).sum()))
    logp = np.log((tri + 1e-4 * np.maximum(total, 1) / used * 100)
                  / (np.maximum(total, 1) * (1 + 1e-2)))
    return {"langs": langs, "logp": logp.astype(np.float32),
            "uses": script >= SCRIPT_SHARE * np.maximum(script.sum(0), 1)}


# ---- scoring ----------------------------------------------------------------

def viterbi(emit: np.ndarray, doc: np.ndarray, n_docs: int, penalty: float = PENALTY) -> np.ndarray:
    """Best language of every word: ``emit`` (words x languages), words of a
    text contiguous, ``doc`` ascending."""
    n, k = emit.shape
    if k == 1 or not n:
        return np.zeros(n, np.int64)
    count = np.bincount(doc, minlength=n_docs)
    begin = np.cumsum(count) - count
    # Chunks: contiguous words of one text.
    per = -(-count // CHUNK)
    chunk_doc = np.repeat(np.arange(n_docs), per)
    first_chunk = np.cumsum(per) - per
    start = begin[chunk_doc] + (np.arange(len(chunk_doc)) - first_chunk[chunk_doc]) * CHUNK
    size = np.minimum(CHUNK, begin[chunk_doc] + count[chunk_doc] - start)
    order = np.argsort(-size, kind="stable")  # full chunks first
    alive = (size[order][:, None] > np.arange(CHUNK)).sum(0)
    # Pass 1: best path through each chunk, by language before it and at its end.
    m = np.full((len(order), k, k), -np.inf, np.float32)
    m[:, np.arange(k), np.arange(k)] = 0
    for s in range(CHUNK):
        a = alive[s]
        if not a:
            break
        x = m[:a]
        np.maximum(x, x.max(2, keepdims=True) - penalty, out=x)
        x += emit[start[order[:a]] + s][:, None, :]
    by_chunk = np.empty_like(m)
    by_chunk[order] = m
    # Pass 2: through the chunks of each text, in lockstep over texts.
    docs = np.argsort(-per, kind="stable")
    docs = docs[per[docs] > 0]
    v = np.zeros((len(docs), k), np.float32)
    came = np.zeros((len(by_chunk), k), np.int16)  # MAX_LANGUAGES fits
    steps = (per[docs][:, None] > np.arange(int(per.max()))).sum(0) if len(docs) else []
    for s, a in enumerate(steps):
        at = first_chunk[docs[:a]] + s
        total = v[:a, :, None] + by_chunk[at]
        came[at] = total.argmax(1)
        v[:a] = total.max(1)
        v[:a] -= v[:a].max(1, keepdims=True)
    out_lang = np.zeros(len(by_chunk), np.int64)
    in_lang = np.zeros(len(by_chunk), np.int64)
    now = v.argmax(1)
    for s in range(len(steps) - 1, -1, -1):
        a = steps[s]
        at = first_chunk[docs[:a]] + s
        out_lang[at] = now[:a]
        now[:a] = came[at, now[:a]]
        in_lang[at] = now[:a]
    # Pass 3: trace each chunk between its two languages.
    v = np.full((len(order), k), -np.inf, np.float32)
    v[np.arange(len(order)), in_lang[order]] = 0
    stay = np.zeros((CHUNK, len(order), k), bool)
    best = np.zeros((CHUNK, len(order)), np.int16)
    for s in range(CHUNK):
        a = alive[s]
        if not a:
            break
        top = v[:a].max(1, keepdims=True) - penalty
        stay[s, :a] = v[:a] >= top
        best[s, :a] = v[:a].argmax(1)
        v[:a] = np.maximum(v[:a], top) + emit[start[order[:a]] + s]
    path = np.zeros(n, np.int64)
    now = out_lang[order].copy()
    for s in range(CHUNK - 1, -1, -1):
        a = alive[s]
        if not a:
            continue
        path[start[order[:a]] + s] = now[:a]
        now[:a] = np.where(stay[s, np.arange(a), now[:a]], now[:a], best[s, :a])
    return path


def label(model: dict, texts: list[str]) -> tuple[list[str], np.ndarray, list[list]]:
    """(language, score, spans) of each text; spans: (language, words) runs."""
    n = len(texts)
    names, result = [UNKNOWN] * n, np.zeros(n)
    spans: list[list] = [[] for _ in range(n)]
    langs = model["langs"]
    if not langs:
        return names, result, spans
    code, first, lens, script, doc = words(texts)
    if not len(first):
        return names, result, spans
    emit = np.add.reduceat(model["logp"][code], first, axis=0)
    uses = model["uses"][script]
    known = uses.any(1)
    emit = np.where(uses | ~known[:, None], emit, np.float32(-1e4))
    path = viterbi(emit, doc, n)
    k = len(langs)
    # Letters by text and language; words of no known script only where alone.
    some = np.bincount(doc, weights=known, minlength=n) > 0
    weight = lens * (known | ~some[doc])
    votes = np.bincount(doc * k + path, weights=weight, minlength=n * k).reshape(n, k)
    top = votes.argmax(1)
    total = votes.sum(1)
    own = path == top[doc]
    like = np.zeros((n, k))
    for j in range(k):
        like[:, j] = np.bincount(doc[own], weights=emit[own, j], minlength=n)
    like -= like.max(1, keepdims=True)
    sure = np.exp(like[np.arange(n), top]) / np.exp(like).sum(1)
    share = votes[np.arange(n), top] / np.maximum(total, 1)
    has = total > 0
    result[has] = (share * sure)[has]
    for i in np.flatnonzero(has):
        names[i] = langs[top[i]]
    turn = np.flatnonzero((np.diff(path, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
    for a, b in zip(turn, np.append(turn[1:], len(path))):
        spans[doc[a]].append({"lang": langs[path[a]], "words": int(b - a)})
    return names, result, spans


_SPANS = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))


def _labeller(model, text: int, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(model.value)
        for b in batches:
            texts = [t or "" for t in b.column(text).to_pylist()]
            for lo, hi in slices(texts, 1_000_000):
                names, score, spans = label(own, texts[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(lo, hi - lo) for c in b.columns), pa.array(names, pa.string()),
                     pa.array(score, pa.float64()), pa.array(spans, _SPANS)],
                    [*b.schema.names, f"{out}_pred", f"{out}_score", f"{out}_spans"])
    return run


def identify(docs: DataFrame, model: dict, text: str = "text", out: str = "lang") -> DataFrame:
    """``docs`` plus ``lang_pred``, ``lang_score`` and ``lang_spans`` (prefix
    ``out``; columns of these names are replaced)."""
    small_batches(docs.sparkSession)
    docs = docs.drop(f"{out}_pred", f"{out}_score", f"{out}_spans")
    shipped = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(
        trimmed(_labeller(shipped, docs.columns.index(text), out)),
        f"{fields}, `{out}_pred` string, `{out}_score` double, "
        f"`{out}_spans` array<struct<lang: string, words: bigint>>")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held = "crc32(cast(doc_id as string)) % 4 = 2"
    model = train(docs.select("doc_id", "text", "lang"), f"not ({held})")
    return (identify(docs.select("doc_id", F.col("text").cast("string")), model)
            .select("doc_id", F.expr(held).alias("held_out"), "lang_pred",
                    F.col("lang_score").alias("score"), F.size("lang_spans").alias("n_spans")))

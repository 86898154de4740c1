"""Benchmark decontamination by template windows.

Texts become templates: numbers, names and units of measure are replaced by
typed slots, all other words are lower-cased.  Windows of ``WINDOW`` template
words are hashed, so a question whose numbers or names were changed has the
same windows as the original.  Document windows meet benchmark windows in a
hash join; windows with fewer than ``LITERALS`` plain words say too little as
templates.  What matched is aligned (same offset between document and
item), and slots are checked: within an alignment each value in the item must
always stand for the same value in the document ("3 ... 3" may become
"5 ... 5", not "5 ... 7").  A document is contaminated by an item if
consistent alignments cover at least ``COVER`` of the item's windows, or one of
them ``PASSAGE`` consecutive words of it, however long the item is.

Items shorter than a window are one window of their own length, as templates
from ``SHORTEST`` words on.  Verbatim copies (but for case and punctuation) are
found whatever the templates say: an item's first window and every window that
is no template join by the words themselves, and an item is found too if
windows of both sorts cover ``COVER`` of all its windows.  One word says too
little inside other text: items below ``ALONE`` words are found where they
stand as a sentence or a line of their own.  Whether an item's first word is a name
cannot be told, so its first window is indexed with a plain word and with a
name.  Before the join, documents' windows pass a bit table
of the benchmark's window hashes, some 16 bits a window up to 2 ** ``MOST_BITS``
bits (32 MB), put together by Spark; false hits fall out of the join.

Defined results: null or empty text -- no windows, not contaminated; null item
texts are not used; repeated rows and repeated doc_ids are flagged alike (a
doc_id is flagged if any of its rows is); an empty benchmark flags nothing.
A null doc_id is flagged as a key of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.llm.bpe import slices
from citystream.llm.common import mix64, read, small_batches, stored, trimmed
from citystream.llm.langid import unicode_tables

WINDOW, LITERALS, SHORTEST, ALONE = 8, 5, 4, 2
COVER = 0.3
#: Consecutive words of an item that contaminate a document by themselves.
PASSAGE = 13
#: Bits of the table as a power of two, least and most.
LEAST_BITS, MOST_BITS = 16, 28
#: Slot types.
LITERAL, NUMBER, NAME, UNIT = 0, 1, 2, 3

#: Units of measure that count as units right behind a number.
UNITS = [
    "mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "ft", "yard", "yards", "mile",
    "miles", "meter", "meters", "metre", "metres", "centimeters", "kilometers", "kilometres",
    "mg", "g", "kg", "gram", "grams", "kilogram", "kilograms", "ton", "tons", "ounce", "ounces",
    "oz", "lb", "lbs", "pound", "pounds", "ml", "l", "liter", "liters", "litre", "litres",
    "gallon", "gallons", "cup", "cups", "second", "seconds", "s", "minute", "minutes", "min",
    "hour", "hours", "h", "day", "days", "week", "weeks", "month", "months", "year", "years",
    "cent", "cents", "dollar", "dollars", "euro", "euros", "usd", "eur", "percent", "degree",
    "degrees", "kmh", "mph", "watt", "watts", "kw", "kwh", "volt", "volts", "joule", "joules",
    "newton", "newtons", "mol", "byte", "bytes", "kb", "mb", "gb", "tb",
]
_MUL = mix64(np.arange(11, 11 + WINDOW, dtype=np.uint64)) | np.uint64(1)
_SLOT = mix64(np.arange(101, 105, dtype=np.uint64))
#: Added to the size in the hash of a window of words themselves.
_EXACT = 1 << 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _word_hash(codes: np.ndarray, first: np.ndarray, lens: np.ndarray) -> np.ndarray:
    pos = np.arange(len(codes)) - np.repeat(first, lens)
    power = np.cumprod(np.full(int(lens.max()), _STEP))
    return mix64(np.add.reduceat(mix64(codes) * power[pos], first) + lens.astype(np.uint64))


def _units() -> np.ndarray:
    cps = np.array([ord(c) for w in UNITS for c in w], np.uint64)
    lens = np.array([len(w) for w in UNITS])
    return np.sort(_word_hash(cps, np.cumsum(lens) - lens, lens))


_UNIT_HASHES = _units()
_EXTRA: dict[str, np.ndarray] = {}


def _digit_table() -> tuple[np.ndarray, np.ndarray]:
    """(digit, upper-case letter) tests of each code point."""
    if not _EXTRA:
        import unicodedata
        t = unicode_tables()
        n = len(t["letter"])
        _EXTRA["digit"] = np.fromiter((unicodedata.category(chr(i)) == "Nd" for i in range(n)),
                                      bool, n)
        _EXTRA["upper"] = t["letter"] & (t["lower"] != np.arange(n))
    return _EXTRA["digit"], _EXTRA["upper"]


def template(texts: list[str]):
    """(template word hash, slot type, value hash, text number, edges) of all
    words; edges: 1 begins a sentence or line, 2 ends one, 3 both.

    Words are runs of letters or of digits with inner points and commas; names
    are capitalised words (one capital, then none) that do not begin a text, a
    line or a sentence."""
    digit, upper = _digit_table()
    t = unicode_tables()
    raw = "\n".join(texts).encode("utf-32-le", "surrogatepass")
    cp = np.frombuffer(raw, np.uint32)
    none = np.zeros(0, np.uint64)
    if not len(cp):
        return none, np.zeros(0, np.int8), none, np.zeros(0, np.int64), np.zeros(0, np.int8)
    ends = np.cumsum([len(x) + 1 for x in texts])
    is_digit, letter = digit[cp], t["letter"][cp]
    point = (cp == 46) | (cp == 44)
    inner = np.zeros(len(cp), bool)
    if len(cp) > 2:
        inner[1:-1] = point[1:-1] & is_digit[:-2] & is_digit[2:]
    kind = letter.astype(np.int8) + 2 * (is_digit | inner).astype(np.int8)
    change = np.flatnonzero(np.diff(kind, prepend=0, append=0))
    a, b = change[:-1], change[1:]
    keep = kind[a] > 0
    a, b = a[keep], b[keep]
    if not len(a):
        return none, np.zeros(0, np.int8), none, np.zeros(0, np.int64), np.zeros(0, np.int8)
    lens = b - a
    first = np.cumsum(lens) - lens
    value = _word_hash(t["lower"][cp[kind > 0]].astype(np.uint64), first, lens)
    doc = np.searchsorted(ends, a, "right")
    up = np.concatenate([[0], np.cumsum(upper[cp])])
    capital = upper[cp[a]] & (up[b] - up[a] == 1) & (lens > 1)
    # Last visible character before the word; none or an end mark: a beginning.
    blank = (cp == 32) | ((cp >= 9) & (cp <= 13)) | (cp == 0xA0)
    line = cp == 10
    seen = np.where(blank & ~line, -1, np.arange(len(cp)))
    np.maximum.accumulate(seen, out=seen)
    before = np.where(a > 0, seen[np.maximum(a - 1, 0)], -1)
    mark = np.where(before >= 0, cp[np.maximum(before, 0)], 10)
    begins = np.isin(mark, np.array([10, 33, 46, 58, 59, 63, 34, 0x201C, 0x2026, 0xBF, 0xA1]))
    slot = np.where(kind[a] == 2, NUMBER, np.where(capital & ~begins, NAME, LITERAL)).astype(np.int8)
    at = np.searchsorted(_UNIT_HASHES, value)
    known = _UNIT_HASHES[np.minimum(at, len(_UNIT_HASHES) - 1)] == value
    behind = np.zeros(len(a), bool)
    behind[1:] = (slot[:-1] == NUMBER) & (doc[1:] == doc[:-1])
    slot[known & behind] = UNIT
    # First visible character behind the word; none or an end mark: an end.
    ahead = np.where(blank & ~line, len(cp), np.arange(len(cp)))
    ahead = np.minimum.accumulate(ahead[::-1])[::-1]
    after = np.where(b < len(cp), ahead[np.minimum(b, len(cp) - 1)], len(cp))
    mark = np.where(after < len(cp), cp[np.minimum(after, len(cp) - 1)], 10)
    stops = np.isin(mark, np.array([10, 33, 46, 58, 59, 63, 34, 0x201D, 0x2026]))
    edges = begins.astype(np.int8) + 2 * stops.astype(np.int8)
    return np.where(slot > 0, _SLOT[slot], value), slot, value, doc, edges


def windows(h: np.ndarray, slot: np.ndarray, doc: np.ndarray, size: int, exact: bool = False):
    """(window hash, position of its first word) of usable windows; of all
    windows if ``exact``, where ``h`` is words' values."""
    if len(h) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = len(h) - size + 1
    w = sum(h[j:j + m] * _MUL[j] for j in range(size))
    use = doc[:m] == doc[size - 1:]
    if not exact:
        plain = np.concatenate([[0], np.cumsum(slot == LITERAL)])
        use &= (plain[size:] - plain[:-size]) >= min(LITERALS, size - 1)
    pos = np.flatnonzero(use)
    return mix64(w[pos] + np.uint64(size + _EXACT * exact)), pos


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """item_id, text -> one row a window: hash, item, position, slots, size,
    whether of the words themselves, number of templates and of all windows."""
    for b in batches:
        texts = [t or "" for t in b.column(1).to_pylist()]
        h, slot, value, doc, _ = template(texts)
        count = np.bincount(doc, minlength=len(texts)) if len(h) else np.zeros(len(texts), int)
        begin = np.cumsum(count) - count
        ids = b.column(0).to_pylist()
        out = {"w": [], "item_id": [], "ipos": [], "isize": [], "exact": [], "iwindows": [],
               "iall": [], "islots": []}
        for i, n in enumerate(count):
            size = min(WINDOW, int(n))
            if not size:
                continue
            s = slice(begin[i], begin[i] + n)
            own, of, words, text = h[s], slot[s], value[s], doc[s]
            rows, n_templates = [], 0
            if size >= SHORTEST:
                w, pos = windows(own, of, text, size)
                n_templates = len(w)
                rows += [(x, p, _slots(of, words, p, size), False)
                         for x, p in zip(w.view(np.int64).tolist(), pos.tolist())]
                if of[0] == LITERAL:
                    named, kind = own[:size].copy(), of[:size].copy()
                    named[0], kind[0] = _SLOT[NAME], NAME
                    w, _ = windows(named, kind, text[:size], size)
                    rows += [(x, 0, _slots(kind, words[:size], 0, size), False)
                             for x in w.view(np.int64).tolist()]
            templates = {p for _, p, _, _ in rows if p}
            w, pos = windows(words, of, text, size, exact=True)
            rows += [(x, p, [], True) for x, p in zip(w.view(np.int64).tolist(), pos.tolist())
                     if p not in templates]
            for x, p, slots, exact in rows:
                out["w"].append(x)
                out["item_id"].append(ids[i])
                out["ipos"].append(p)
                out["isize"].append(size)
                out["exact"].append(exact)
                out["iwindows"].append(n_templates)
                out["iall"].append(int(n) - size + 1)
                out["islots"].append(slots)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[k], t) for k, t in (
                ("w", pa.int64()), ("item_id", pa.int64()), ("ipos", pa.int64()),
                ("isize", pa.int32()), ("exact", pa.bool_()), ("iwindows", pa.int64()),
                ("iall", pa.int64()), ("islots", pa.list_(pa.int64())))], list(out))


def _slots(slot: np.ndarray, value: np.ndarray, pos: int, size: int) -> list[int]:
    own = slice(pos, pos + size)
    return value[own][slot[own] > 0].view(np.int64).tolist()


def _hits(bits, power: int, sizes: list[tuple[int, bool]]):
    """doc_id, text -> windows whose hash is in the bit table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits.value, np.uint8)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for lo, hi in slices(texts, 1_000_000):
                h, slot, value, doc, edges = template(texts[lo:hi])
                if not len(h):
                    continue
                start = np.searchsorted(doc, np.arange(hi - lo))
                for size, exact in sizes:
                    w, pos = windows(value if exact else h, slot, doc, size, exact)
                    code = (w >> np.uint64(64 - power)).astype(np.int64)
                    ok = (table[code >> 3] >> (code & 7).astype(np.uint8)) & 1 == 1
                    if size < ALONE:
                        ok &= (edges[pos] & 1 > 0) & (edges[pos + size - 1] & 2 > 0)
                    w, pos = w[ok], pos[ok]
                    if not len(w):
                        continue
                    own = doc[pos]
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(own + lo)), pa.array(w.view(np.int64)),
                         pa.array(pos - start[own]),
                         pa.array([[] if exact else _slots(slot, value, p, size) for p in pos],
                                  pa.list_(pa.int64()))], ["doc_id", "w", "dpos", "dslots"])
    return run


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, covered, windows): items that contaminate documents,
    with the number of the item's windows that consistent alignments cover."""
    spark = docs.sparkSession
    small_batches(spark)
    items = stored(benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
                   .where("text is not null")
                   .mapInArrow(_item_rows,
                               "w long, item_id long, ipos long, isize int, exact boolean, "
                               "iwindows long, iall long, islots array<bigint>"), "item-windows")
    # At most WINDOW sizes of two kinds.
    sizes = {(r["isize"], r["exact"]): r["n"] for r in
             items.groupBy("isize", "exact").agg(F.count("*").alias("n")).collect()}
    power = min(MOST_BITS, max(LEAST_BITS, sum(sizes.values()).bit_length() + 4))
    # The table in pieces of 32,768 bits, put together where the windows are.
    code = F.shiftrightunsigned("w", 64 - power) + 1
    bits = np.zeros(1 << (power - 3), np.uint8)
    for r in items.groupBy(F.bitmap_bucket_number(code).alias("at")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(code)).alias("piece")).toLocalIterator():
        piece = np.frombuffer(r["piece"], np.uint8)[:len(bits)]
        bits[(r["at"] - 1) * 4096:(r["at"] - 1) * 4096 + len(piece)] = piece
    shipped = spark.sparkContext.broadcast(bits.tobytes())
    hits = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(trimmed(_hits(shipped, power, sorted(sizes))),
                        "doc_id long, w long, dpos long, dslots array<bigint>"))
    pairs = F.arrays_zip(F.col("islots").alias("i"), F.col("dslots").alias("d"))
    aligned = (hits.join(items, "w")
               .select("doc_id", "item_id", "iwindows", "iall", "ipos", "isize", "exact",
                       (F.col("dpos") - F.col("ipos")).alias("shift"), pairs.alias("pairs"))
               .groupBy("doc_id", "item_id", "shift")
               # Bounded by the item's own length: its windows and its slots.
               .agg(F.collect_set("ipos").alias("at"),
                    F.collect_set(F.when(~F.col("exact"), F.col("ipos"))).alias("templates"),
                    F.max("iwindows").alias("n_templates"), F.max("iall").alias("windows"),
                    F.max("isize").alias("size"),
                    F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("p")))
    sound = aligned.where(F.size("p") == F.size(F.array_distinct(F.col("p").getField("i"))))
    # Words in a row that the windows of one alignment cover: a window goes on
    # where the last one ends, or before.
    sound = sound.withColumn("passage", F.expr("""
        aggregate(array_sort(at),
                  struct(cast(0 as bigint) as first, cast(0 as bigint) as stop, cast(0 as bigint) as most),
                  (s, p) -> struct(
                      if(p <= s.stop, s.first, p) as first, p + size as stop,
                      greatest(s.most, p + size - if(p <= s.stop, s.first, p)) as most),
                  s -> s.most)"""))

    def places(of: str):
        return F.size(F.array_distinct(F.flatten(F.collect_set(of)))).cast("long")
    enough = ((F.col("found") > 0) & (F.col("found") >= F.ceil(F.lit(COVER) * F.col("n_templates")))
              | (F.col("covered") >= F.ceil(F.lit(COVER) * F.col("windows")))
              | (F.col("passage") >= PASSAGE))
    return (sound.groupBy("doc_id", "item_id")
            .agg(places("at").alias("covered"), F.max("windows").alias("windows"),
                 places("templates").alias("found"), F.max("n_templates").alias("n_templates"),
                 F.max("passage").alias("passage"))
            .where(enough).select("doc_id", "item_id", "covered", "windows"))


def flagged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, items): contaminated doc_ids and the items found in them."""
    return (matches(docs, benchmark).groupBy("doc_id")
            .agg(F.array_sort(F.collect_set("item_id")).alias("items")))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated documents."""
    bad = flagged(docs, benchmark).select(F.col("doc_id").alias("__bad"))
    return docs.join(bad, F.col("doc_id").cast("long").eqNullSafe(F.col("__bad")), "left_anti")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    bad = flagged(docs, read(spark, sf_dir, "benchmark"))
    bad = bad.withColumnRenamed("doc_id", "__bad")
    return (docs.select("doc_id").join(bad, F.col("doc_id").eqNullSafe(F.col("__bad")), "left")
            .select("doc_id", F.col("items").isNotNull().alias("contaminated"),
                    F.coalesce(F.concat_ws(",", F.col("items").cast("array<string>")), F.lit(""))
                    .alias("items")))

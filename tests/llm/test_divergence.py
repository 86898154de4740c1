"""op12: counts, shares and ranks against brute force."""

import re
from collections import Counter

import numpy as np
import pytest

from citystream.llm import divergence as D

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, least=30, top=50):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER)))
            for text, lang, source in rows]
    df, counts = Counter(), Counter()
    for lang, source, ts in docs:
        df.update((lang, t) for t in set(ts))
        counts.update((lang, source, t) for t in ts)
    out = []
    groups = {(lang, source) for lang, source, _ in docs}
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (x, t), n in df.items() if x == lang and n >= least)
        sources = sorted(s for x, s in groups if x == lang)

        def p(of):
            c = [sum(counts[lang, s, t] for s in of) for t in kept]
            return c, [1 + 10 ** 9 * (x + 5) // (sum(c) + 5 * len(kept)) for x in c]
        every = p(sources)[1]
        own = {s: p([s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(x - y) for x, y in zip(own[s][1], own[o][1])), o.encode())
                     for o in sources if o != s]
            terms = [(q - x, t.encode()) for c, x, q, t in zip(*own[s], every, kept) if c and x > q]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, i.decode(), -v, r + 1) for r, (v, i) in enumerate(items)]
    return sorted(out)


def audited(spark, rows, **kw):
    df = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr(
        "*", "1 as term", "2 as shard", "'x' as item")
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"])
                  for r in D.audit(df, **kw).collect())


def corpus(seed=1):
    r = np.random.default_rng(seed)
    words = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(100)]
    words += ["Été", "ÉTÉ", "naïve", "日本", "x" * 60, "x" * 61, "ß \u0085q", "KK"]
    rows = []
    for i in range(400):
        lang, source = ["en", "de", None, ""][r.integers(4)], ["a", "b", "ä", None, "", "z z"][r.integers(6)]
        lo = r.integers(0, 40)
        ws = r.choice(words[lo:], r.integers(0, 60))
        rows.append((["-", " ", "1", "\n", "@[`{"][r.integers(5)].join(ws), lang, source))
    rows += [(None, "en", "a"), ("", "en", "only"), (None, "fr", None), ("one two", "xx", "s"),
             ("7 8 --", "xx", "t"), ("wak " * 20000, "en", "long"), rows[0], rows[0]]
    return rows


@pytest.mark.parametrize("keys,bytes_,sources,dense", [(4096, 8 << 20, 128, 96 << 20), (7, 600, 2, 700)])
def test_against_brute_force(spark, monkeypatch, keys, bytes_, sources, dense):
    """Also with many small shards, rounds, blocks of sources and full tables."""
    for name, x in (("SHARD_KEYS", keys), ("ROUND_BYTES", bytes_), ("SOURCES", sources),
                    ("DENSE_BYTES", dense), ("TABLE_TERMS", keys * 10)):
        monkeypatch.setattr(D, name, x)
    rows = corpus()
    want = brute(rows)
    assert audited(spark, rows) == want
    assert {r[2] for r in want} == {"pair", "term"}


def test_fewer_terms_and_documents(spark):
    rows = corpus(2)
    assert audited(spark, rows, least=3, top=4) == brute(rows, 3, 4)
    assert audited(spark, rows, least=10 ** 6) == brute(rows, 10 ** 6)
    assert audited(spark, []) == []


def test_perfect_hash_knows_its_keys():
    words = [f"k{i}".encode() for i in range(3000)] + [b"y" * 100, b"z" * 100]
    levels, order = D.build_shard(words)
    assert sorted(order) == list(range(len(words)))
    row = {"lang": "en", "shard": 0, "shards": 1, "n": len(words), "levels": levels,
           "keys": [D._stored(words[i]) for i in order]}
    look = D.Lookup([row])
    assert sorted(look.slots(b"en", words).tolist()) == list(range(len(words)))
    assert (look.slots(b"en", [f"n{i}".encode() for i in range(5000)] + [b"y" * 101]) == -1).all()
    assert (look.slots(b"de", words) == -1).all()


def test_shares_are_exact():
    r = np.random.default_rng(3)
    c = np.concatenate([r.integers(0, 10 ** 13, 200), [0, 0, 10 ** 13]])
    for n, v in ((10 ** 13, 10 ** 6), (int(c.max()), 1), (2 * 10 ** 14, 10 ** 9)):
        want = [1 + 10 ** 9 * (int(x) + 5) // (n + 5 * v) for x in c]
        assert D.shares(c, n, v).tolist() == want

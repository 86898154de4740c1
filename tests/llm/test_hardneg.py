"""op11: Four-Russians scores and mined rows against brute force."""

import math

import numpy as np
import pytest

from citystream.llm import hardneg as H

SCHEMA = "vec_id long, embedding array<double>, label int"


def _floor(x):
    return int(x) * 256 if abs(x) >= 2.0 ** 53 else math.floor(x * 256)


def brute(rows, ids, positives=5, negatives=3, low=50, high=95):
    ok = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(
                x is None or not math.isfinite(x) for x in v):
            continue
        ok[i] = min(ok.get(i, (label, list(v))), (label, list(v)))
    ints = {i: (label, [_floor(x) for x in v]) for i, (label, v) in ok.items()}
    out = []
    for a in sorted(set(ids) & set(ints)):
        la, va = ints[a]
        s = sorted((-sum(x * y for x, y in zip(va, v)), i, la == label)
                   for i, (label, v) in ints.items() if i != a)
        for p, pid, _ in [x for x in s if x[2]][:positives]:
            fit = [(n, i) for n, i, same in s if not same and low * -p <= 100 * -n <= high * -p]
            out += [(a, pid, r + 1, i, -p, -n) for r, (n, i) in enumerate(fit[:negatives])]
    return sorted(out)


def mined(spark, rows, ids, **kw):
    v = H.labelled_vectors(spark.createDataFrame(rows, SCHEMA))
    asks = spark.createDataFrame([(i,) for i in ids], "vec_id long")
    return sorted((x.anchor_id, x.positive_id, x["rank"], x.negative_id, x.positive_score,
                   x.negative_score) for x in H.mine(v, asks, **kw).collect())


@pytest.mark.parametrize("dim,most", [(1, 3), (8, 300), (13, 2 ** 40), (64, 256)])
def test_scores_are_inner_products(dim, most):
    r = np.random.default_rng(dim)
    q = r.integers(-most, most + 1, (5, dim))
    c = r.integers(-most, most + 1, (40, dim))
    want = c.astype(object) @ q.astype(object).T
    exact = most > 2 ** 20
    got = H.scores(H.subset_sums(q.astype(object) if exact else q), H.bit_planes(c), exact)
    assert (got == want).all()


@pytest.mark.parametrize("cell,block", [(2048, 256), (16, 4)])
def test_against_brute_force(spark, monkeypatch, cell, block):
    monkeypatch.setattr(H, "CELL", cell)
    monkeypatch.setattr(H, "BLOCK", block)
    r = np.random.default_rng(3)
    centres = r.normal(size=(4, 10))
    rows = [(i, (centres[i % 4] + r.normal(size=10)).tolist(), i % 3) for i in range(300)]
    rows += [(1000 + i, rows[7][1], i % 3) for i in range(150)]  # one vector many times: ties
    rows += [(2000, [0.0] * 10, 1), (2001, [30.0] * 10, 2), (2002, [1.0, 2.0], 0), (2003, None, 1),
             (2004, [], 1), (2005, [None] * 10, 1), (2006, [float("nan")] * 10, 1), (2007, [1.0], None),
             (2008, [float("inf")], 0), (None, [1.0], 1), (3, rows[3][1], 0), (4, [-1.0] * 10, 1),
             (2010, [5.0] * 10, 77)]
    ids = [x[0] for x in rows if x[0] is not None and (x[0] % 10 == 0 or x[0] in (2002, 2004))]
    assert mined(spark, rows, ids) == brute(rows, ids)
    assert mined(spark, rows, ids, positives=2, negatives=7, low=10, high=100) == brute(
        rows, ids, 2, 7, 10, 100)


@pytest.mark.parametrize("large", [4e7, 1e12])
def test_large_components(spark, large):
    r = np.random.default_rng(5)
    rows = [(i, r.normal(size=6).tolist(), i % 2) for i in range(60)]
    rows += [(100, [large, 0.0, 0.0, 0.0, 0.0, 1.0], 0), (101, [-large] * 6, 1), (102, [large / 3, 1.0, 0.0, 0.0, 0.0, 0.0], 1)]
    ids = [0, 10, 20]
    want = brute(rows, ids)
    assert mined(spark, rows, ids) == want and want
    asked = [0, 100, 101, 102]
    most = 2 ** 63 - 1
    clamped = [(*x[:4], *(max(-most, min(most, s)) for s in x[4:])) for x in brute(rows, asked)]
    assert mined(spark, rows, asked) == clamped


def test_huge_components_do_not_crash(spark):
    rows = [(0, [1.0, 2.0], 0), (1, [1e300, 0.0], 0), (2, [0.5, 1.0], 1), (3, [1.0, 2.0], 0)]
    got = mined(spark, rows, [0])
    assert (0, 3, 1, 2, 5 * 65536, int(2.5 * 65536)) in got


def test_none(spark):
    none = H.labelled_vectors(spark.createDataFrame([], SCHEMA))
    assert H.mine(none, none.select("vec_id")).collect() == []
    alone = H.labelled_vectors(spark.createDataFrame([(0, [1.0], 1), (50, [1.0], 1)], SCHEMA))
    assert H.mine(alone, alone.select("vec_id")).collect() == []


def test_other_columns_are_not_read(spark):
    rows = [(i, [float(i % 5), 1.0], i % 2) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as score", "2 as cell", "3 as x")
    v = H.labelled_vectors(df)
    got = H.mine(v, v.select("vec_id").where("vec_id % 10 = 0")).collect()
    assert sorted(tuple(x) for x in got) == brute(rows, [0, 10, 20])

"""op13: brute-force comparison, guarantees of the filters, odd rows."""

from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from citystream.llm import ngramjoin as J

W = J.WORDS


def sets(rows):
    out = {}
    for i, t in rows:
        w = ("" if t is None else t).encode().lower().split()
        out[i] = (frozenset([tuple(w)]) if 0 < len(w) < W
                  else frozenset(tuple(w[k:k + W]) for k in range(len(w) - W + 1)))
    return out


def brute(rows, percent=85):
    of = sets(rows)
    near = defaultdict(set)
    for a, b in combinations(of, 2):
        both = len(of[a] & of[b])
        if of[a] and of[b] and 100 * both >= percent * (len(of[a]) + len(of[b]) - both):
            near[a].add(b)
            near[b].add(a)
    out = {}
    for i in sorted(of):
        if i in out:
            continue
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = i
                todo += near[x]
    return {i: (len(of[i]), out[i]) for i in of}


def joined(docs, **kw):
    return {x.doc_id: (x.n_shingles, x.component_id) for x in J.jaccard_join(docs, **kw).collect()}


def edited(text, every, mark):
    words = text.split()
    words[::every] = [f"{mark}{k}" for k in range(len(words[::every]))]
    return " ".join(words)


@pytest.mark.parametrize("part", [1 << 21, 50])
@pytest.mark.parametrize("percent", [85, 60])
def test_against_brute_force(spark, documents, prose, monkeypatch, part, percent):
    monkeypatch.setattr(J, "PART_TOKENS", part)
    rows, n = [], 0
    r = np.random.default_rng(5)
    for g in range(12):
        base = prose(g, int(r.integers(3, 300)))
        rows.append((n, base))
        n += 1
        for k in range(int(r.integers(0, 8))):
            rows.append((n, edited(base, int(r.integers(12, 120)), f"x{g}q{k}")))
            n += 1
    # A chain: neighbours are linked, its ends are not.
    text = prose(99, 400).split()
    for k in range(12):
        rows.append((n, " ".join(text[8 * k:8 * k + 250])))
        n += 1
    rows += [(n, "  Same\tWords here "), (n + 1, "same words HERE"), (n + 2, ""), (n + 3, None),
             (n + 4, "É è"), (n + 5, "é È"), (n + 6, "one two three four"), (n + 7, "One two three four")]
    assert joined(documents(rows), percent=percent) == brute(rows, percent)


@pytest.mark.parametrize("small", [4, 10_000])
def test_large_group_of_near_copies(spark, documents, prose, monkeypatch, small):
    monkeypatch.setattr(J, "BLOCK", 16)
    monkeypatch.setattr(J, "SMALL", small)
    base = prose(1, 120)
    rows = [(i, edited(base, 37 + i % 7, f"e{i}x")) for i in range(150)]
    rows += [(500 + i, base) for i in range(40)]
    rows += [(700 + i, edited(base, 12, f"f{i}x")) for i in range(30)]
    rows += [(800 + i, base + " " + prose(200 + i, 18)) for i in range(30)]
    rows += [(900 + i, prose(300 + i, 100) + " " + base[:200]) for i in range(40)]
    assert joined(documents(rows)) == brute(rows)


def test_random_sets(spark, documents):
    """Few words, so many lists are long and similarities lie around the bound."""
    r = np.random.default_rng(8)
    rows = []
    for g in range(6):
        base = r.integers(0, 9, 60).astype(str)
        for k in range(25):
            w = base.copy()
            at = r.integers(0, 60, r.integers(0, 4))
            w[at] = r.integers(0, 9, len(at)).astype(str)
            rows.append((100 * g + k, " ".join(w[:r.integers(50, 61)])))
    assert joined(documents(rows)) == brute(rows)


def test_needed_overlap():
    for n in range(1, 60):
        for m in range(n, 60):
            k = J.needed(n, m, 85)
            assert 100 * k >= 85 * (n + m - k) and 100 * (k - 1) < 85 * (n + m - k + 1)


def test_packed_arrays():
    x = np.sort(np.random.default_rng(1).integers(0, 2 ** 48, 999)).astype(np.uint64)
    assert (J.unpack(J.pack(x)) == x).all() and len(J.pack(x)) == 999 * J.BYTES
    assert len(J.unpack(J.pack(x[:0]))) == 0


def test_one_component_needs_no_block_pairs(spark, documents, prose, monkeypatch):
    """Block pairs grow with the stragglers of a list, not with its main component."""
    monkeypatch.setattr(J, "BLOCK", 8)
    monkeypatch.setattr(J, "SMALL", 4)
    seen = []
    stored = J.stored

    def spy(df, name):
        out = stored(df, name)
        if name == "spots":
            seen.append((out.count(), out.where("not pure").select("block").distinct().count()))
        return out
    monkeypatch.setattr(J, "stored", spy)
    base = prose(4, 150)
    rows = [(i, edited(base, 60 + i % 5, f"e{i}x")) for i in range(200)]
    rows += [(900, edited(base, 11, "z"))]
    assert joined(documents(rows)) == brute(rows)
    assert all(mixed <= 2 for _, mixed in seen)


def test_odd_rows(spark, documents, prose):
    long_text = prose(8, 20000)
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, None), (None, None),
            (3, long_text), (4, long_text + " tail"), (5, "a b c d e f")]
    got = sorted(((x.doc_id, x.n_shingles, x.component_id)
                  for x in J.jaccard_join(documents(rows)).collect()), key=str)
    assert got.count((1, 3, 1)) == 2 and (5, 3, 1) in got
    assert (None, 3, None) in got and (None, 0, None) in got and (2, 0, 2) in got
    assert [x[2] for x in got if x[0] == 4] == [3]
    assert J.jaccard_join(documents([])).count() == 0
    clash = documents([(1, "a", 7, "x")], "doc_id long, text string, cls long, component_id string")
    assert J.jaccard_join(clash).collect() == [(1, 1, 1)]

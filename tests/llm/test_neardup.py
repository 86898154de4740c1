"""op1: brute-force comparison, guarantees of the index, odd rows."""

from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from citystream.llm import neardup
from citystream.llm.neardup import deduplicate, near_duplicates


def _sets(rows):
    out = {}
    for i, t in rows:
        w = ("" if t is None else t).encode().lower().split()
        out[i] = (frozenset([tuple(w)]) if 0 < len(w) < 5
                  else frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)))
    return out


def brute(rows, percent=85):
    sets = _sets(rows)
    near = defaultdict(set)
    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            near[a].add(b)
            near[b].add(a)
    out = {}
    for i in sorted(sets):
        if i in out:
            continue
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = i
                todo += near[x]
    return {i: (len(sets[i]), out[i], out[i] == i) for i in sets}


def _edited(text, every, mark):
    words = text.split()
    words[::every] = [f"{mark}{k}" for k in range(len(words[::every]))]
    return " ".join(words)


def test_against_brute_force(spark, documents, prose):
    rows, n = [], 0
    r = np.random.default_rng(5)
    for g in range(12):
        base = prose(g, int(r.integers(3, 300)))
        rows.append((n, base))
        n += 1
        for k in range(int(r.integers(0, 8))):
            rows.append((n, _edited(base, int(r.integers(20, 200)), f"x{g}q{k}")))
            n += 1
    # A chain: neighbours are linked, its ends are not.
    text = prose(99, 400).split()
    for k in range(12):
        rows.append((n, " ".join(text[8 * k:8 * k + 250])))
        n += 1
    rows += [(n, "  Same\tWords here "), (n + 1, "same words HERE"), (n + 2, ""), (n + 3, None),
             (n + 4, "É è"), (n + 5, "é È"), (n + 6, "one two three four five")]
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept)
           for x in near_duplicates(documents(rows)).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("small", [4, 10_000])
def test_large_group_of_near_copies(spark, documents, prose, monkeypatch, small):
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "SMALL", small)
    base = prose(1, 120)
    rows = [(i, _edited(base, 37 + i % 7, f"e{i}x")) for i in range(150)]
    rows += [(500 + i, base) for i in range(40)]
    rows += [(700 + i, _edited(base, 12, f"f{i}x")) for i in range(30)]
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept)
           for x in near_duplicates(documents(rows)).collect()}
    assert got == brute(rows)


def test_block_pairs_grow_with_stragglers(spark, documents, prose, monkeypatch):
    """Blocks of a bucket's main component do not meet each other."""
    monkeypatch.setattr(neardup, "BLOCK", 8)
    monkeypatch.setattr(neardup, "SMALL", 4)
    seen, stored = [], neardup.stored

    def spy(df, name):
        out = stored(df, name)
        if name == "spots":
            seen.append((out.select("block").distinct().count(),
                         out.where("not pure").select("block").distinct().count()))
        return out
    monkeypatch.setattr(neardup, "stored", spy)
    base = prose(4, 300)
    rows = [(i, _edited(base, 150 + i % 5, f"e{i}x")) for i in range(120)]
    rows += [(900, _edited(base, 27, "z")), (901, _edited(base, 30, "y"))]
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept)
           for x in near_duplicates(documents(rows)).collect()}
    assert got == brute(rows)
    assert all(mixed <= 3 for _, mixed in seen)


def test_every_pair_within_radius_shares_a_key():
    r = np.random.default_rng(3)
    a = r.integers(0, 2 ** 16, neardup.SYMBOLS).astype("<u2")
    import pyarrow as pa
    for _ in range(50):
        b = a.copy()
        b[r.permutation(neardup.SYMBOLS)[:neardup.RADIUS]] ^= 1
        keys = [set(x.column(0).to_pylist()) for x in neardup._keys(iter(
            [pa.RecordBatch.from_arrays([pa.array([0]), pa.array([s.tobytes()])], ["cls", "sig"])
             for s in (a, b)]))]
        assert keys[0] & keys[1]


def test_odd_rows(spark, documents, prose):
    long_text = prose(8, 20000)
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, None), (None, None),
            (3, long_text), (4, long_text + " tail"), (5, "a b c d e f")]
    got = sorted(((x.doc_id, x.n_shingles, x.component_id, x.kept)
                  for x in near_duplicates(documents(rows)).collect()), key=str)
    assert (1, 2, 1, True) in got and got.count((1, 2, 1, True)) == 2
    assert (5, 2, 1, False) in got and (None, 2, None, True) in got and (2, 0, 2, True) in got
    assert [x[2] for x in got if x[0] == 4] == [3]
    kept = deduplicate(documents(rows))
    assert kept.columns == documents(rows).columns
    assert sorted((x.doc_id for x in kept.collect()), key=str) == [1, 2, 3, None, None]
    assert near_duplicates(documents([])).count() == 0
    clash = documents([(1, "a", 7, "x")], "doc_id long, text string, cls long, component_id string")
    assert deduplicate(clash).collect()[0].asDict() == {
        "doc_id": 1, "text": "a", "cls": 7, "component_id": "x"}

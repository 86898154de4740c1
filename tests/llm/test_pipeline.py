"""The corpus pipeline: stages against the operators' brute-force versions."""

import hashlib

import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline as P  # noqa: E402
from citystream.llm import bpe  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stage_list():
    assert [n for n, _ in P.STAGES] == ["toxicity", "language_id", "near_duplicates",
                                        "decontamination", "bpe"]


def test_stages_in_turn(spark):
    from tests.llm.test_neardup import brute
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in P.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        # A stage only takes documents away; what stays is unchanged.
        assert all(before[i] == r for i, r in after.items())
        seen[name] = (before, after)
        docs = spark.createDataFrame(list(after.values()), docs.schema)
    before, after = seen["near_duplicates"]
    want = brute([(i, r.text) for i, r in before.items()], P.NEAR_PERCENT)
    assert set(after) == {i for i, (_, _, kept) in want.items() if kept}
    before, after = seen["language_id"]
    assert {i for i in set(before) - set(after)} == {
        i for i, r in before.items() if not any(c.isalpha() for c in r.text or "")}
    for _, (before, after) in seen.items():
        assert after and len(after) >= 0.5 * len(before)
    tok = bpe.load(__import__("public_tokenizers").path("word_bpe_49k.json"))
    out = {r.doc_id: r for r in P.STAGES[-1][1](spark, docs, SF).collect()}
    assert set(out) == set(after)
    for i, r in out.items():
        ids = tok.encode(after[i].text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_near_duplicates_from_80_percent(spark, documents, prose):
    """Copies with similarities on both sides of 0.80, most below 0.85."""
    from tests.llm.test_neardup import _sets, brute
    rows = []
    for g in range(60):
        words = prose(g, 300).split()
        changed = words.copy()
        for k in range(4 + g % 5):
            changed[20 + 35 * k] = f"x{g}q{k}"
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(changed))]
    sets = _sets(rows)
    like = [len(sets[2 * g] & sets[2 * g + 1]) / len(sets[2 * g] | sets[2 * g + 1])
            for g in range(60)]
    assert sum(0.80 <= x < 0.85 for x in like) >= 20 and min(like) < 0.80
    want = brute(rows, 80)
    kept = {r.doc_id for r in P.near_duplicate_stage(spark, documents(rows), SF).collect()}
    assert kept == {i for i, (_, _, stays) in want.items() if stays}
    assert kept != {i for i, (_, _, stays) in brute(rows).items() if stays}


def test_odd_rows_pass_every_stage(spark, tables, documents, prose):
    """Nulls anywhere, empty and long texts, repeated rows, other columns."""
    clean = [(i, prose(i, 60), "en", "s", 1) for i in range(30)]
    odd = [(100, None), (101, ""), (102, "..."), (None, prose(200, 50), "en"), (103, prose(7, 20000)),
           (5, prose(5, 60), "en", "s", 1), (104, prose(208, 50), None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = documents(clean + odd, schema).selectExpr(
        "*", "1 as toxicity", "2 as __lang", "'x' as ids", "3 as cls", "4 as items")
    sf = tables(labels=spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 1, 1)],
                                             "doc_id long, quality int, toxic int"),
                benchmark=spark.createDataFrame([(1, prose(3, 60)), (2, None)],
                                                "item_id long, text string"))
    columns = docs.columns
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == columns, name
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
    left = sorted((r.doc_id for r in rows), key=str)
    assert left == sorted([i for i in range(30) if i != 3] + [None, 103, 104], key=str)
    assert {r.toxicity for r in rows} == {1} and {r.ids for r in rows} == {"x"}
    assert P.STAGES[-1][1](spark, docs, sf).count() == len(left)


def test_empty_table(spark, tables, documents):
    sf = tables(documents=documents([]),
                labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"),
                benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert P.run(spark, sf).count() == 0

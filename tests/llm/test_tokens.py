"""op2 and op6: exact agreement with the library, index, odd rows."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")
from citystream.llm import bpe, tokens, wordbpe  # noqa: E402

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n", "x <|endoftext|> y",
       "<|startoftext|>q  r", "café é", "a\xa0b \xa0 c", "a\x1cb \x1c", "it's 'll we'VE \t x",
       "\x00 a \x00", "１２ ３  四五", "ß ﬁ İ", "🙂 🙂🙂"]


@pytest.mark.parametrize("path", [BYTE, WORD])
@pytest.mark.parametrize("limit", [400_000, 40])
def test_piecewise_encoding_is_exact(path, limit, prose, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_PIECES", limit)
    table = bpe.PieceTable(path)
    tok = bpe.load(path)

    @settings(max_examples=60, deadline=None)
    @given(st.lists(st.text(alphabet=" \n\tab.é'1\xa0<|s　ß", max_size=40), max_size=6))
    def check(texts):
        texts = texts + ODD + [prose(len(texts), 50)]
        ids, n = table.encode(texts)
        for t, own in zip(texts, np.split(ids, np.cumsum(n)[:-1])):
            assert own.tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)
    check()


def test_words_are_encoded_once_with_any_mark_behind():
    """The library gets a word once, not once for each mark and line behind it."""
    table = bpe.PieceTable(BYTE)
    tok, given = table.tok, []

    class Spy:
        def encode_batch_fast(self, texts, **kw):
            given.extend(texts)
            return tok.encode_batch_fast(texts, **kw)

    table.tok = Spy()
    words = [f"{a}{b}ème" for a in "ofthandlestre" for b in "qwertyuiop"]
    behind = ["", ".", ",", "!", "?)", ".\nOf", ",\nof", "\nThe"]
    texts = [" ".join(w + b for w in ["x", *words]) for b in behind]
    ids, n = table.encode(texts)
    for t, own in zip(texts, np.split(ids, np.cumsum(n)[:-1])):
        assert own.tolist() == tok.encode(t, add_special_tokens=False).ids
    assert sum(map(len, given)) < 2 * len(texts[0])


@pytest.mark.parametrize("limit", [400_000, 40])
def test_cut_words_are_exact(limit, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_PIECES", limit)
    table, tok = bpe.PieceTable(BYTE), bpe.load(BYTE)

    @settings(max_examples=400, deadline=None)
    @given(st.lists(st.text(alphabet=" \n\n\t\r.,'sléÿ×9_<|>\uffff\x1c\x85٣字", max_size=24), max_size=8))
    def check(texts):
        texts = texts + ODD + ["a\nb\nc.\nd", "\uffff", "a \uffffb", "\uffff\n x", "x.\n's", "x\n\ny.\n", "l'été, n'a."]
        ids, n = table.encode(texts)
        for t, own in zip(texts, np.split(ids, np.cumsum(n)[:-1])):
            assert own.tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)
    check()


def test_perfect_hash():
    keys = np.arange(-500, 5000)
    h = tokens.key_hash(keys, np.zeros(len(keys), np.int32))
    levels = tokens.mph_build(h)
    slots = tokens.mph_find(levels, h)
    assert sorted(slots.tolist()) == list(range(len(keys)))  # minimal and perfect


def test_written_ids_come_back(spark, documents, tmp_path, prose):
    r = np.random.default_rng(2)
    rows = [(int(i), t) for i, t in zip(r.permutation(len(ODD)) * 7 - 50, ODD)]
    rows += [(1000, None), (1001, prose(4, 30000)), (1002, "same"), (1002, "same"), (1002, "other"),
             (None, "no id")]
    about = tokens.write_tokens(documents(rows), str(tmp_path / "out"), BYTE, shards=3)
    keys = about["entries"].select("doc_id", "occ")
    back = tokens.read_tokens(spark, about, tokens.find_tokens(spark, about, keys)).collect()
    tok = bpe.load(BYTE)
    want = sorted((str(i), tok.encode(t or "", add_special_tokens=False).ids + [0])
                  for i, t in rows)
    got = sorted((str(x.doc_id), np.frombuffer(x.ids, about["dtype"]).tolist()) for x in back)
    assert got == want
    # Ascending keys: start grows with doc_id over shards and within them.
    order = [x.doc_id for x in sorted(back, key=lambda x: (x.shard, x.at)) if x.doc_id is not None]
    assert order == sorted(order)
    # Absent keys are rejected by their fingerprints.
    absent = spark.range(5000, 9000).selectExpr("id as doc_id", "0 as occ")
    assert tokens.find_tokens(spark, about, absent).count() == 0


def test_query_digests(spark, documents, tables, prose):
    rows = [(3, "b c"), (1, prose(1, 40)), (2, None), (9, "")]
    got = {x.doc_id: (x.start, x.n_tokens, x.ids_crc32)
           for x in tokens.op2_token_binary(spark, tables(documents=documents(rows))).collect()}
    tok, start, want = bpe.load(BYTE), 0, {}
    for i, t in sorted(rows):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert got == want


def test_empty_table(spark, documents, tables):
    folder = tables(documents=documents([]))
    assert tokens.op2_token_binary(spark, folder).count() == 0
    assert wordbpe.op6_word_bpe(spark, folder).count() == 0


def test_word_table_encoding(spark, documents, prose):
    texts = ODD + [None, prose(3, 5000), prose(3, 200), prose(3, 200)]
    docs = documents([(i, t, 5, "x") for i, t in enumerate(texts)],
                     "doc_id long, text string, ids long, decoded string")
    tok = bpe.load(WORD)
    for table in (None, wordbpe.word_table(docs, WORD, limit=7)):
        got = wordbpe.decode(wordbpe.encode(docs, WORD, table=table), WORD).collect()
        for x in got:
            ids = tok.encode(x.text or "", add_special_tokens=False).ids
            assert x.ids == ids and x.decoded == tok.decode(ids, skip_special_tokens=False)
    rows = wordbpe.digests(docs, WORD).collect()
    for x in rows:
        ids = tok.encode(texts[x.doc_id] or "", add_special_tokens=False).ids
        assert x.n_tokens == len(ids)
        assert x.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert x.decoded_sha256 == hashlib.sha256(
            tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_table_keeps_whole_count_classes(spark, documents):
    docs = documents([(1, "a a a a b b c d e f")])
    assert sorted(r.word for r in wordbpe.word_table(docs, WORD, limit=3).collect()) == ["a", "b"]
    assert wordbpe.word_table(docs, WORD, limit=100).count() == 6


def test_decode_by_join(spark):
    ids = spark.createDataFrame([(1, 0, 320), (1, 1, 530), (2, 0, 320)], "k int, pos int, id int")
    tok = bpe.load(WORD)
    got = {x.k: x.decoded for x in wordbpe.decode_by_join(ids, WORD, "k").collect()}
    assert got == {1: tok.decode([320, 530], skip_special_tokens=False),
                   2: tok.decode([320], skip_special_tokens=False)}

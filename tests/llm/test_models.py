"""op9, op10: Viterbi against step-by-step search, held-out accuracy, odd rows."""

import zlib

import numpy as np
import pytest

from citystream.llm import langid, toxicity

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("chunk", [3, 64])
def test_viterbi_finds_the_best_path(chunk, monkeypatch):
    monkeypatch.setattr(langid, "CHUNK", chunk)
    r = np.random.default_rng(chunk)
    for _ in range(60):
        k, count = int(r.integers(2, 4)), r.integers(0, 12 if chunk == 3 else 200, 6)
        emit = r.normal(0, 4, (int(count.sum()), k)).astype(np.float32)
        path = langid.viterbi(emit, np.repeat(np.arange(6), count), 6, 5.0)
        begin = np.cumsum(count) - count
        for b, c in zip(begin, count):
            best = np.zeros(k)
            for t in range(c):
                best = np.maximum(best, best.max() - 5.0) + emit[b + t]
            own = path[b:b + c]
            got = emit[b + np.arange(c), own].sum() - 5.0 * (own[1:] != own[:-1]).sum()
            assert c == 0 or abs(got - best.max()) < 1e-2


@pytest.mark.parametrize("k", [200, langid.MAX_LANGUAGES])
def test_viterbi_of_many_languages(k, monkeypatch):
    monkeypatch.setattr(langid, "CHUNK", 4)
    r = np.random.default_rng(k)
    emit = r.normal(0, 4, (90, k)).astype(np.float32)
    path = langid.viterbi(emit, np.repeat(np.arange(3), 30), 3, 5.0)
    assert path.min() >= 0
    for b in range(0, 90, 30):
        best = np.zeros(k)
        for t in range(30):
            best = np.maximum(best, best.max() - 5.0) + emit[b + t]
        own = path[b:b + 30]
        got = emit[b + np.arange(30), own].sum() - 5.0 * (own[1:] != own[:-1]).sum()
        assert abs(got - best.max()) < 1e-2


LANGS = {"en": "the house and the river were quiet when they walked home through the rain",
         "de": "das Haus und der Fluss waren ruhig als sie durch den Regen nach Hause gingen",
         "ru": "дом и река были тихими когда они шли домой под дождём через старый город"}


def test_languages(spark, documents):
    rows = [(3 * i + j, " ".join(np.random.default_rng(i).permutation(t.split())), lang)
            for i in range(30) for j, (lang, t) in enumerate(LANGS.items())]
    model = langid.train(documents(rows))
    assert model["langs"] == ["de", "en", "ru"]
    mixed = LANGS["en"] + ". " + LANGS["ru"] + " " + LANGS["ru"]
    odd = documents([(1, mixed, "xx"), (2, None), (3, ""), (4, "12 !? 34"), (5, LANGS["de"] * 3000),
                     (6, "ηταν ησυχα"), (7, LANGS["en"]), (7, LANGS["en"])])
    got = {x.doc_id: x for x in langid.identify(odd, model).collect()}
    assert got[1].lang_pred == "ru" and [s.lang for s in got[1].lang_spans] == ["en", "ru"]
    assert [got[i].lang_pred for i in (2, 3, 4)] == ["und"] * 3
    assert [got[i].lang_score for i in (2, 3, 4)] == [0.0] * 3
    assert got[5].lang_pred == "de" and got[6].lang_pred in LANGS and got[7].lang_pred == "en"
    assert all(0 <= x.lang_score <= 1 for x in got.values())
    clash = documents([(1, LANGS["en"], "q")], "doc_id long, text string, lang_pred string")
    assert langid.identify(clash, model).columns == ["doc_id", "text", "lang_pred", "lang_score",
                                                     "lang_spans"]
    empty = langid.train(documents([]))
    assert [x.lang_pred for x in langid.identify(odd, empty).collect()] == ["und"] * 8


def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = langid.op9_language_id(spark, SF).join(docs, "doc_id").collect()
    held = [x for x in rows if x.held_out]
    assert len(rows) == docs.count()
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in rows)
    assert np.mean([x.lang_pred == x.lang for x in held]) >= 0.97


INSULTS = ["grumbug", "snotwit", "blorkface"]


def _labelled(prose, n=240, seed=0):
    r = np.random.default_rng(seed)
    texts, toxic = [], []
    for i in range(n):
        words = prose(1000 * seed + i, int(r.integers(20, 90))).split()
        bad = i % 4 == 0
        if bad:
            words.insert(int(r.integers(0, len(words))), INSULTS[i // 4 % 3])
        texts.append(" ".join(words))
        toxic.append(int(bad))
    return texts, np.array(toxic)


def _fitted(spark, prose):
    texts, toxic = _labelled(prose)
    rows = [(i, int(y), t) for i, (t, y) in enumerate(zip(texts, toxic))]
    return toxicity.fit(spark.createDataFrame(rows, "doc long, toxic int, text string"),
                        int(toxic.sum()), int((1 - toxic).sum()))


def test_insults_with_gaps_and_insertions(spark, prose):
    model = _fitted(spark, prose)
    texts, toxic = _labelled(prose, 120, 1)
    score = toxicity.score(model, texts)
    assert ((score >= 0.7) == toxic).mean() >= 0.97
    clean = prose(77, 60)
    variants = ["gr.um.bug", "g r u m b u g", "snot-wit", "grumxbug", "snotw1it", "BLORKFACE!",
                "blork_face", "grum\u2014bug", "gr\u200bum\u200bb\u200bug", "\u201cgrum\u2019bug\u201d",
                "s\u2022n\u2022o\u2022t\u2022w\u2022i\u2022t", "grumbug\u00a0" + "x" * 3]
    assert (toxicity.score(model, [f"{clean} {v} {clean}" for v in variants]) >= 0.7).all()
    assert toxicity.score(model, [clean])[0] < 0.5


def test_long_words_are_wholly_in_the_vocabulary():
    import pyarrow as pa
    word = "".join(chr(97 + i % 26) for i in range(70))
    b = pa.RecordBatch.from_pydict({"doc": pa.array([5, 6, 7]), "toxic": pa.array([1, 0, 0], pa.int32()),
                                    "text": [f"ab {word}", word + " ab ab", ""]})
    got = [r for x in toxicity._bags(iter([b])) for r in x.to_pylist()]
    lines = {d: {r["line"] for r in got if r["doc"] == d} for d in (5, 6, 7)}
    assert lines[5] == lines[6] and not lines[7]
    seen = {chr(96 + c) for line in lines[5] for c in line if 0 < c < 27}
    assert seen == set(word)
    # "ab", the first letters, windows every twelve letters.
    assert len(lines[5]) == 1 + 1 + len(range(12, 70, 12))
    assert len(got) == 2 * len(lines[5])


def test_no_text_reaches_the_driver(spark, prose, documents, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    monkeypatch.setattr(DataFrame, "toPandas", None)
    collected = []
    collect = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect",
                        lambda self: collected.append(self.columns) or collect(self))
    arrow = DataFrame.toArrow
    monkeypatch.setattr(DataFrame, "toArrow",
                        lambda self: collected.append(self.columns) or arrow(self))
    texts, toxic = _labelled(prose)
    labels = spark.createDataFrame([(i, int(t)) for i, t in enumerate(toxic)], "doc_id long, toxic int")
    toxicity.train(documents(list(enumerate(texts))), labels, rows=40)
    assert collected and not {"text", "line", "word"} & {c for cols in collected for c in cols}


def test_collapsed_table_is_the_landmark_expansion(prose):
    letters, first, _ = toxicity.words([prose(5, 60)])
    m, *_ = toxicity.distinct(letters, first)
    marks, a = m[:7], np.linspace(-1, 1, 7)
    direct = toxicity.kernel(m, marks) @ a
    assert np.allclose(direct, toxicity.apply(toxicity._spread(marks, a), m), atol=1e-3)
    # Against a loop over the letters of two words.
    x, y = m[3], m[9]

    def phi(row):
        out, s = {}, [int(c) for c in row if c]
        for i in range(len(s)):
            for j in range(i + 1, len(s)):
                for k in range(j + 1, len(s)):
                    if k - i < toxicity.SPAN:
                        key = (s[i], s[j], s[k])
                        out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i + 1)
        return out
    p, q = phi(x), phi(y)
    dot = sum(v * q.get(u, 0) for u, v in p.items())
    own = toxicity.kernel(np.array([x]), np.array([y]))[0, 0]
    assert abs(own - dot / toxicity.norms(np.array([x]))[0] / toxicity.norms(np.array([y]))[0]) < 1e-4


def test_odd_texts_and_labels(spark, documents, prose):
    texts, toxic = _labelled(prose)
    docs = documents(list(enumerate(texts)))
    labels = spark.createDataFrame(
        [(i, int(t)) for i, t in enumerate(toxic)] + [(None, 1), (3, None), (3, 0)],
        "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    odd = documents([(1, None, 9.0), (2, "", 9.0), (3, "12 ...", 9.0),
                     (4, prose(3, 20000) + " grumbug", 9.0), (5, "x" * 5000 + " é", 9.0),
                     (6, "grumbug", 9.0), (6, "grumbug", 9.0)],
                    "doc_id long, text string, toxicity double")
    got = toxicity.score_documents(odd, model).collect()
    assert len(got) == 7 and all(0 <= x.toxicity <= 1 for x in got)
    score = {x.doc_id: x.toxicity for x in got}
    assert score[6] >= 0.7 and score[4] > 0.5 and max(score[i] for i in (1, 2, 3)) < 0.5
    none = toxicity.train(docs, labels.where("false"))
    assert {x.toxicity for x in toxicity.score_documents(odd, none).collect()} == {0.0}
    assert toxicity.score_documents(documents([]), model).count() == 0


def test_toxicity_accuracy(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    rows = toxicity.op10_toxicity(spark, "/root/testdata/sf0.1").join(labels, "doc_id") \
        .where("held_out").collect()
    hit = [x for x in rows if x.predicted == 1]
    assert all(zlib.crc32(str(x.doc_id).encode()) % 3 == 1 for x in rows)
    assert np.mean([x.toxic for x in hit]) >= 0.8
    assert sum(x.toxic for x in hit) >= 0.6 * sum(x.toxic for x in rows)

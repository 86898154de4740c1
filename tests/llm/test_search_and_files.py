"""op3, op4, op5, op7, op8: brute force, round trips, odd rows."""

import hashlib

import numpy as np
import pytest

from citystream.llm import chat, decontam, htmlmain, topk, warc

# ---- op4 --------------------------------------------------------------------


def _brute_top(rows, ids, k):
    ok = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = [int(np.floor(64 * float(x))) for x in v]
        ok[i] = min(ok.get(i, q), q)
    dim = max((len(v) for v in ok.values()), default=0)
    m = {i: np.array(v + [0] * (dim - len(v)), np.int64) for i, v in ok.items()}
    out = []
    for q in sorted(set(ids) & set(m)):
        s = sorted(((-int(m[q] @ v), i) for i, v in m.items() if i != q))[:k]
        out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    return out


@pytest.mark.parametrize("cell,block", [(2048, 256), (16, 4)])
def test_top_k_against_brute_force(spark, monkeypatch, cell, block):
    monkeypatch.setattr(topk, "CELL", cell)
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    r = np.random.default_rng(1)
    centres = r.normal(size=(5, 8))
    rows = [(i, (centres[i % 5] + r.normal(size=8) * 0.2).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]  # one vector many times: ties
    rows += [(2000, [0.0] * 8), (2001, [30.0] * 8), (2002, [1.0, 2.0]), (2003, None), (2004, []),
             (2005, [None] * 8), (2006, [float("nan")] * 8), (2007, [float("inf")] * 8), (None, [1.0]),
             (3, rows[3][1]), (4, [-1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    v = topk.integer_vectors(df)
    ids = [i for i, _ in rows if i is not None and (i % 20 == 0 or i in (2002, 2004))]
    asks = spark.createDataFrame([(i,) for i in ids], "vec_id long")
    got = sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in topk.top_k(v, asks, 6).collect())
    assert got == _brute_top(rows, ids, 6)


@pytest.mark.parametrize("large", [4e7, 1e8, 1e12, 1e300])
def test_top_k_of_large_components(spark, large):
    """Scores within 64 bits are exact, others leave as the nearest long."""
    r = np.random.default_rng(2)
    rows = [(i, r.normal(size=4).tolist()) for i in range(50)]
    rows += [(100, [large, 0.5, 0.0, 0.0]), (101, [-large, 1.0, 2.0, large / 2]), (102, [1.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ids = [0, 20, 40, 100, 102]
    got = sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in topk.top_k(
        topk.integer_vectors(df), spark.createDataFrame([(i,) for i in ids], "vec_id long"), 5).collect())
    most = 2 ** 63 - 1
    v = {i: [int(x) * 64 if abs(x) >= 2 ** 53 else int(np.floor(64 * x))
             for x in np.clip(xs, -1e140, 1e140).tolist()] for i, xs in rows}
    want = []
    for q in ids:
        s = sorted((-max(-most, min(most, sum(a * b for a, b in zip(v[q], v[i])))), i) for i in v if i != q)
        want += [(q, k + 1, i, -x) for k, (x, i) in enumerate(s[:5])]
    assert got == want


def test_ties_at_the_last_place_stay_in_their_cells(spark):
    """A visit gives only rows before the query's k-th result."""
    import pyarrow as pa
    q = pa.RecordBatch.from_arrays(
        [pa.array([x], pa.binary()) for x in (
            np.array([7], "<i8").tobytes(), np.ones((1, 2), "<f8").tobytes(),
            np.array([[6, 50]], "<i8").tobytes(), np.arange(100, dtype="<i8").tobytes(),
            np.full((100, 2), 3, "<f8").tobytes())], ["ids", "vs", "taus", "cids", "cvs"])
    out = [x for b in topk._visit(60, 2)(iter([q])) for x in b.to_pylist()]
    assert [x["vec_id"] for x in out] == [i for i in range(50) if i != 7]


def test_top_k_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (20, [2.0]), (5, [-1.0])],
                               "vec_id long, embedding array<float>")
    v = topk.integer_vectors(df)
    got = topk.top_k(v, v.select("vec_id").where("vec_id % 20 = 0"), 20).collect()
    assert sorted((x.query_id, x["rank"], x.vec_id) for x in got) == [
        (0, 1, 20), (0, 2, 5), (20, 1, 0), (20, 2, 5)]
    none = topk.integer_vectors(df.where("false"))
    assert topk.top_k(none, none.select("vec_id"), 5).count() == 0


# ---- op3 --------------------------------------------------------------------

PAGE = "page_id long, url string, html string"


def test_warc_round_trip_for_every_split(spark, tmp_path):
    same = "<p>" + "copy " * 60 + "</p>"
    rows = [(5, "http://a/5", same), (2, "http://a/2", same), (9, "http://a/9\r\nX: y", same),
            (1, None, None), (3, "u", ""), (4, "u", "short"), (6, "u", "short"),
            (7, "ü/é", "é" * 200_000), (None, "u", same), (8, "u", "\x1f\x8b\x08 WARC/1.1 no"),
            (2, "http://a/2", same)]
    folder = str(tmp_path / "w")
    pages = spark.createDataFrame(rows, PAGE).repartition(3)
    files = warc.write_warc(pages, folder)
    want = sorted(str((i, "revisit" if len((h or "").encode()) >= 100 and h == same and i != 2
                       else "response", 2 if h == same and i != 2 else None,
                       len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest()))
                  for i, _, h in rows)
    for split in (61, 1000, 1 << 20):
        got = warc.read_warc(files, folder, split=split).collect()
        assert sorted(str((x.page_id, x.record_type, x.refers_to, x.payload_bytes,
                           x.payload_digest)) for x in got) == want
    assert {bytes(x.payload).decode() for x in got if x.page_id == 7} == {"é" * 200_000}
    none = warc.write_warc(spark.createDataFrame([], PAGE), str(tmp_path / "e"))
    assert none.count() == 0 and warc.read_warc(none, str(tmp_path / "e")).count() == 0


def test_warc_header_across_read_edges(spark, tmp_path):
    """Small pages over several MB: members begin with any number of bytes left
    in the window; one header is longer than what is decoded at first."""
    r = np.random.default_rng(7)
    rows = [(i, f"http://a/{i}", r.bytes(int(r.integers(20, 900))).hex()) for i in range(8000)]
    rows.append((8000, "http://a/" + r.bytes(70_000).hex(), "far"))
    folder = str(tmp_path)
    digest = {i: hashlib.sha256(h.encode()).hexdigest() for i, _, h in rows}
    raw = b"".join(warc._record(i, u, h.encode(), digest[i], len(h), None) for i, u, h in rows)
    (tmp_path / "one.warc.gz").write_bytes(raw)
    assert len(raw) > 3 * warc.READ
    files = spark.createDataFrame([("one.warc.gz", len(raw))], "file string, size long")
    want = sorted((i, len(u), digest[i]) for i, u, _ in rows)
    for split in (300_007, warc.SPLIT):
        got = warc.read_warc(files, folder, split=split).collect()
        assert sorted((x.page_id, len(x.url), x.payload_digest) for x in got) == want


def test_warc_header_across_every_read_edge(monkeypatch):
    """Blocks of a few bytes: the header's end is never in the first one."""
    import io
    raw = b"".join(warc._record(i, "u" * 50 * i, b"x" * i, "d", i, None) for i in range(5))

    class Source(io.BytesIO):
        def read_at(self, n, at):
            return self.getvalue()[at:at + n]
    for size in (1, 3, 64, 300):
        monkeypatch.setattr(warc, "READ", size)
        for edge in range(0, len(raw), 37):
            own = [*warc.records(Source(raw), 0, edge), *warc.records(Source(raw), edge, len(raw))]
            assert [warc.parse(x)["page_id"] for x in own] == [0, 1, 2, 3, 4]


def test_damaged_record_is_noticed(spark, tmp_path):
    folder = str(tmp_path / "w")
    files = warc.write_warc(spark.createDataFrame([(1, "u", "abc")], PAGE), folder)
    bad = warc._record(2, "u", b"abd", hashlib.sha256(b"abc").hexdigest(), 3, None)
    name = files.first().file
    with open(f"{folder}/{name}", "ab") as f:
        f.write(b"\x1f\x8b\x08junk" + bad)
    longer = files.selectExpr("file", f"size + {len(bad) + 7} as size")
    with pytest.raises(Exception, match="damaged record of page 2"):
        warc.read_warc(longer, folder).collect()
    assert warc.read_warc(longer, folder, check=False).count() == 2


# ---- op5 --------------------------------------------------------------------

TURN = "conv_id long, turn long, role string, text string"


def test_chat_round_trip(spark):
    rows = [(1, 0, "system", "be [INST] good"), (1, 1, "user", "a\\b <s>"), (1, 2, "assistant", "</s>"),
            (2, 0, "user", None), (2, 1, "assistant", "x\n\\[/INST]\\\\"), (2, 2, "user", "tail"),
            (3, 0, "assistant", "first"), (4, 0, "tool", "[ROLE]"), (4, 1, None, "n"),
            (5, 0, "user", "same"), (5, 0, "user", "same"), (None, 0, "user", "<<SYS>>"),
            (6, 5, "assistant", "late " * 50_000), (6, 1, "user", "early")]
    segments = chat.format_chats(spark.createDataFrame(rows, TURN)).cache()
    got = {x.conv_id: x for x in chat.read_chats(segments).collect()}
    convs = {}
    for r in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2] or "", r[3] or "")):
        convs.setdefault(r[0], []).append(r)
    assert set(got) == set(convs)
    for k, own in convs.items():
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        x = got[k]
        assert x.n_turns == len(own) and x.loss_chars == len(loss)
        assert x.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert x.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert {k: x.valid for k, x in got.items()} == {
        1: True, 2: False, 3: False, 4: False, 5: False, None: False, 6: True}
    plain = segments.where("conv_id = 1").orderBy("seq").collect()
    assert "".join(x.text for x in plain) == (
        "<<SYS>>be \\[INST] good<</SYS>>[INST]a\\\\b \\<s>[/INST]<s>\\</s></s>")
    assert [x.text for x in plain if x.loss] == ["\\</s>"]
    assert chat.format_chats(spark.createDataFrame([], TURN)).count() == 0


# ---- op7 --------------------------------------------------------------------

FULL = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header class="site-header"><h1>Site</h1><a href=/>Home</a></header>
<div id=cookie-notice>We use cookies on this site to give the best experience to you</div>
<div id="wrap"><div class="sidebar"><ul><li><a>one</a><li><a>two</a></ul></div>
<div id="content"><h2>Title &amp; more</h2><p>First para with   many words, <b>bold</b> words &eacute;.
<p>Second para<br>broken line with words and words.</p><form><input><button>Go</button></form>
<div class="ad">Buy this thing now it is cheap</div><script>var x="</p>";</script>
<ul><li>item one is here</li><li>item two is here</li></ul><p>End.</p>
<div class="comments"><p>nice article I like it very much thank you all</p></div></div></div>
<footer>copyright all rights</footer></body></html>"""
MAIN = ["Title & more", "First para with many words, bold words é.",
        "Second para broken line with words and words.", "item one is here", "item two is here", "End."]


@pytest.mark.parametrize("page,want", [
    (FULL, MAIN), (None, []), ("", []), ("   ", []), ("<p>x", ["x"]), ("</p></div>hello<b>", ["hello"]),
    ("<!-- never ends", []), ("&amp;&#x41;", ["&A"]), ("<script>x", []),
    ("<article><p>a &lt;b&gt; c</p>\n<p>\xa0 </p></article>", ["a <b> c"]),
    ("<div>" * 30_000 + "deep" + "</div>" * 30_000, ["deep"]),
    ("<a <a <b" * 20_000, ["<a <a <b" * 20_000]),
    ("<nav>" + "<a>menu</a>" * 50 + "</nav><article><p>one</p></article>", ["one"]),
])
def test_main_text(page, want):
    for weights in ({}, {"p": 0.0, "div": -0.1, "li": -4.0, "a": -6.0}):
        assert htmlmain.main_text(page, weights) == "\n\n".join(want)


def test_best_region_against_all_regions(prose):
    """The linear scan finds what trying every run of blocks finds."""
    r = np.random.default_rng(4)
    w = {"p": -2.0, "li": -6.0, "div": -1.0}
    for _ in range(30):
        tags = r.choice(["p", "li", "div"], 12)
        page = "".join(f"<{t}>{prose(int(r.integers(1e6)), int(r.integers(1, 9)))}</{t}>" for t in tags)
        found = htmlmain.blocks(page)
        words = [len(b.text().split()) for b in found]
        cost = [sum(w.get(t.lstrip("/"), 0.0) for t in b.tags) for b in found]
        best = max((sum(words[i:j + 1]) + sum(cost[i + 1:j + 1]), -i, -j)
                   for i in range(len(found)) for j in range(i, len(found)))
        lo, hi = -best[1], -best[2]
        assert htmlmain.main_text(page, w) == "\n\n".join(b.text() for b in found[lo:hi + 1])


def _pages(n=120):
    import duckdb
    return [h for (h,) in duckdb.sql("SELECT html FROM '/root/testdata/sf0.01/pages.parquet' "
                                     f"ORDER BY page_id LIMIT {n}").fetchall()]


def _inside(page):
    return "\n\n".join(b.text() for b in htmlmain.blocks(page) if b.inside)


def test_held_out_pages_without_the_labelled_element():
    """Weights of one half read the other half's articles, named div there."""
    pages = _pages()
    w = htmlmain.weights_from(htmlmain.count_tags(pages[::2]))
    hidden = [p.replace("<article", "<div").replace("</article", "</div") for p in pages[1::2]]
    same = [htmlmain.main_text(h, w) == _inside(p) for h, p in zip(hidden, pages[1::2])]
    assert np.mean(same) >= 0.95
    assert np.mean([htmlmain.main_text(p, w) == _inside(p) for p in pages[1::2]]) >= 0.95


def test_weights_decide_and_names_do_not():
    import re
    pages = _pages()
    w = htmlmain.weights_from(htmlmain.count_tags(pages))
    text = [htmlmain.main_text(p, w) for p in pages]
    flat = [htmlmain.main_text(p, dict.fromkeys(w, 0.0)) for p in pages]
    assert np.mean([a != b for a, b in zip(text, flat)]) >= 0.9
    named = [re.sub(r'class="[^"]*"', 'class="zq"', p) for p in pages]
    assert np.mean([a == htmlmain.main_text(p, w) for a, p in zip(text, named)]) >= 0.95


def test_html_query(spark, tables):
    rows = [(1, "u", FULL), (1, "u", FULL), (2, None, None), (None, "v", "<article>x y</article>"),
            (3, "w", "<article><p>" + "word " * 200_000 + "</p></article>")]
    folder = tables(pages=spark.createDataFrame([(*r, "clash") for r in rows],
                                                PAGE + ", main_text string"))
    got = htmlmain.op7_html_text(spark, folder).collect()
    assert len(got) == 5
    assert [x.text for x in got if x.page_id == 1] == ["\n\n".join(MAIN)] * 2
    assert {x.n_chars for x in got if x.page_id == 3} == {999_999}
    empty = spark.createDataFrame([], PAGE)
    assert htmlmain.extract(empty, htmlmain.learn_weights(empty)).count() == 0


# ---- op8 --------------------------------------------------------------------

ITEM = ("Tom has 3 apples and buys 5 kg more apples from Maria, then he gives 3 apples back to "
        "Maria and keeps the rest for himself.")
ITEMS = "item_id long, text string"


def _swap(**values):
    t = ITEM
    for k, v in (("3", "{a}"), ("5 kg", "{b}"), ("Maria", "{m}"), ("Tom", "{t}")):
        t = t.replace(k, v)
    return t.format(**{"a": 3, "b": "5 kg", "m": "Maria", "t": "Tom"} | values)


def test_templates(spark, documents, prose):
    wrong = ITEM.replace("gives 3", "gives 4")
    docs = [(1, "We saw: " + ITEM), (2, prose(1, 40) + ". " + _swap(a=7, b="9 lb", m="Anna")),
            (3, wrong), (4, prose(2, 300)), (5, None), (6, ""), (7, ITEM.upper()),
            (8, prose(3, 5000) + "\n" + ITEM + "\n" + prose(4, 5000)), (8, "repeated id"), (None, ITEM)]
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "four short words here"),
                                   (1, ITEM)], ITEMS)
    got = {x.doc_id: x.items for x in decontam.flagged(documents(docs), bench).collect()}
    assert got == {1: [1], 2: [1], 8: [1], None: [1]}
    short = spark.createDataFrame([(1, "Yes"), (2, "The red one.")], ITEMS)
    said = documents([(1, "I said yes to them."), (2, "Is it so? Yes! It is."), (3, "no\nyes\nno"),
                      (4, "Take the red one there"), (5, "Which? The red one."), (6, "yes")])
    assert {x.doc_id: x.items for x in decontam.flagged(said, short).collect()} == {
        2: [1], 3: [1], 4: [2], 5: [2], 6: [1]}
    left = decontam.decontaminate(documents(docs), bench)
    assert sorted(x.doc_id for x in left.collect()) == [3, 4, 5, 6, 7]
    assert left.columns == documents(docs).columns
    assert decontam.flagged(documents(docs), bench.where("false")).count() == 0
    assert decontam.flagged(documents([]), bench).count() == 0


def test_verbatim_items_without_templates(spark, documents, prose):
    """Mostly slots, very short, or beginning with a word that looks like a name."""
    items = ["Compute 12 + 7 - 3 * 4 / 2", "Who wrote The Old Man And The Sea?", "Define entropy.",
             "What is the capital of France?", "Name 1 prime", "Tom sold 4 apples to some other boys",
             "Add 1 2 3 4 5 6 7 8 9 10 11 12"]
    bench = spark.createDataFrame(list(enumerate(items)), ITEMS)
    docs = [(i, f"{prose(i, 30)} {x} {prose(50 + i, 30)}") for i, x in enumerate(items)]
    docs += [(10, "we say Compute 12 + 7 - 3 * 4 / 5"), (11, "Define the entropy"),
             (12, "they say Anna sold 9 apples to some other boys"), (13, prose(9, 200))]
    got = {x.doc_id: x.items for x in decontam.flagged(documents(docs), bench).collect()}
    assert got == {i: [i] for i in range(len(items))} | {12: [5]}


def test_passages_of_long_items(spark, documents, prose):
    """A passage counts by its length in words, not as a share of its item."""
    items = {1: prose(1, 59), 2: prose(2, 500)}
    bench = spark.createDataFrame(list(items.items()), ITEMS)

    def passage(item, start, words):
        return " ".join(items[item].split()[start:start + words])
    docs = [(1, passage(1, 20, 20)), (2, passage(2, 100, 150)), (3, passage(2, 300, 13)),
            (4, passage(2, 300, 12)), (5, passage(2, 10, 8) + " else " + passage(2, 19, 12)),
            (6, passage(1, 0, 13)), (7, passage(2, 487, 13))]
    docs = [(i, f"{prose(10 + i, 40)} {t} {prose(30 + i, 40)}") for i, t in docs]
    got = {x.doc_id: x.items for x in decontam.flagged(documents(docs), bench).collect()}
    assert got == {1: [1], 2: [2], 3: [2], 6: [1], 7: [2]}


def test_planted_passages_against_brute_force(spark):
    import re
    sf = "/root/testdata/sf0.01"

    def grams(t):
        w = re.findall(r"[^\W_]+", t.lower())
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    items = [grams(x.text) for x in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {d.doc_id for d in docs
            if any(len(grams(d.text) & g) >= 0.5 * len(g) for g in items)}
    got = decontam.op8_decontamination(spark, sf).collect()
    assert len(got) == len(docs)
    assert {x.doc_id for x in got if x.contaminated} == want

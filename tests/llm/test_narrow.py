"""Language ID, toxicity, HTML extraction and sharding."""

import os
import random
import subprocess
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tests.llm.data import DOCS, hostile_documents
from turnloom.llm import html_extract, langid, sharding, toxicity
from turnloom.llm.common import append_columns


# ---------------------------------------------------------------- language ID
def naive_grams(text):
    out = Counter()
    word = ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            p = f" {word} "
            out.update(word)
            out.update(p[i : i + 2] for i in range(len(p) - 1))
            out.update(p[i : i + 3] for i in range(len(p) - 2))
            word = ""
    return out


def rank(counts, size):
    key = lambda g: tuple(ord(c) for c in g) + (0,) * (3 - len(g))
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], key(x[0])))[:size]]


def code(g):
    cp = [ord(c) for c in g] + [0] * (3 - len(g))
    return cp[0] << 42 | cp[1] << 21 | cp[2]


def test_gram_counts_match_a_plain_count():
    texts = ["Straße, ÉTÉ 12 été", "", "a", "one two one", "x" * 50, "日本語 テキスト", " ..", "ab\ncd"]
    row, c, n = langid.gram_counts(texts, np.arange(len(texts)))
    got = {}
    for r, x, k in zip(row.tolist(), c.tolist(), n.tolist()):
        got.setdefault(r, {})[x] = k
    for i, t in enumerate(texts):
        assert got.get(i, {}) == {code(g): k for g, k in naive_grams(t).items()}


def test_identify_against_brute_force(spark):
    rng = random.Random(1)
    langs = {"aa": "kalo mira tesu", "bb": "xorp yndt wzq", "cc": "éàü ñoß kal"}
    rows = [(i, " ".join(rng.choice(langs[g].split()) + rng.choice(["", "o", "x"]) for _ in range(rng.randrange(1, 60))), g, "s", 1) for i, g in enumerate(list(langs) * 15)]
    rows += hostile_documents(n=10)[:25] + [(900, "kalo", None, None, None), (901, "123 !!", "aa", None, None), (902, None, "bb", None, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("source", "score")
    size = 25
    p = langid.learn(docs, profile_size=size)
    want = {}
    for g in sorted({r[2] for r in rows if r[2] is not None and naive_grams(r[1])}):
        total = Counter()
        for r in rows:
            if r[2] == g:
                total.update(naive_grams(r[1]))
        want[g] = rank(total, size)
    assert p.langs == sorted(want)
    got = sorted(((r.doc_id, r.text, r.lang_pred, round(r.score, 9)) for r in langid.identify(docs, p).collect()), key=str)
    exp = []
    for r in rows:
        grams = rank(naive_grams(r[1]), size)
        if not grams:
            exp.append((r[0], r[1], "und", 0.0))
            continue
        dist = [sum(abs(i - want[g].index(x)) if x in want[g] else size for i, x in enumerate(grams)) for g in p.langs]
        exp.append((r[0], r[1], p.langs[dist.index(min(dist))], round(1 - min(dist) / (len(grams) * size), 9)))
    assert got == sorted(exp, key=str)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held", langid.held_out())
    p = langid.learn(docs.where("NOT held"))
    got = langid.identify(docs.where("held"), p).selectExpr("avg(int(lang_pred = lang)) a").first()
    assert got.a > 0.97


def test_no_profiles_and_empty_table(spark):
    docs = spark.createDataFrame(hostile_documents(n=3), DOCS)
    p = langid.learn(docs.where("false"))
    assert {r.lang_pred for r in langid.identify(docs, p).collect()} == {"und"}
    assert langid.identify(docs.where("false"), p).count() == 0


# ---------------------------------------------------------------- toxicity
def test_severity_learns_ordered_grades(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(600):
        t = [rng.choice(vocab) for _ in range(40)]
        bad = i % 4 == 0
        if bad:
            t[5] = rng.choice(["foul", "vile", "nasty"])
        rows.append((i, " ".join(t).upper() if i % 7 == 0 else " ".join(t), 2 if bad and i % 8 == 0 else int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    model = toxicity.fit(df, df.where("doc_id < 400"))
    assert model.thresholds[0] <= model.thresholds[1]
    got = toxicity.score(df.where("doc_id >= 400").withColumnRenamed("grade", "toxic_label"), model).collect()
    wrong = sum(r.toxic != (r.toxic_label > 0) for r in got)
    assert wrong <= len(got) * 0.03
    clean = [r.severity for r in got if r.toxic_label == 0]
    assert max(clean) < min(r.severity for r in got if r.toxic)


def test_severity_on_odd_rows_and_without_labels(spark):
    docs = spark.createDataFrame(hostile_documents(n=4), DOCS)
    none = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, grade int"))
    got = toxicity.score(docs.withColumnRenamed("lang", "severity"), none).collect()
    assert len(got) == docs.count() and not any(r.toxic for r in got)
    one = toxicity.fit(docs, spark.createDataFrame([(1, 0), (2, 0), (402, 0), (None, 1), (4, None)], "doc_id long, grade int"))
    assert not any(r.toxic for r in toxicity.score(docs, one).collect())
    assert toxicity.score(docs.where("false"), one).count() == 0


def test_held_out_toxicity(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    grades = toxicity.graded(spark.read.parquet(f"{sf}/labels.parquet"))
    model = toxicity.fit(docs, grades.where("doc_id % 5 <> 0"))
    held = docs.join(grades.where("doc_id % 5 = 0").withColumnRenamed("grade", "y"), "doc_id")
    r = toxicity.score(held, model).selectExpr("avg(int(toxic = (y > 0))) acc", "sum(int(toxic and y = 0)) / sum(int(y = 0)) fp").first()
    assert r.acc > 0.93 and r.fp < 0.02


# ---------------------------------------------------------------- HTML
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>no</article>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav>
<div class="cookie-notice">We use cookies, which is a long sentence about cookies and consent.</div>
<article><h1>Head &amp; line</h1><p>First   para<br>with&nbsp;<b>bold</b> text &lt;x&gt; that is long enough to read.<p>Hi.</p>
<aside>Related story</aside><div class="ad-slot">Buy now</div><form><label>Mail</label><input></form>
<p>Third &#233;t&eacute; paragraph, again with a number of words in it.</p><!-- no --></article>
<section id="comments"><article class="comment"><p>I disagree with this long article in many many words indeed.</p></article></section>
<div class="sidebar"><p>Side text that is also rather long and could be taken for content.</p></div><footer>&copy; me</footer></body></html>"""
MAIN = "Head & line First para with bold text <x> that is long enough to read. Hi. Third été paragraph, again with a number of words in it."


def test_main_text_of_an_article():
    assert html_extract.main_text(PAGE) == MAIN


def test_main_text_without_article_element():
    page = PAGE.replace('<article><h1>Head', '<div id="story"><h1>Head').replace("<!-- no --></article>", "</div>")
    assert html_extract.main_text(page) == MAIN


@pytest.mark.parametrize("page", ["", "   ", "<nav>only</nav>", "<script>x", "<div class=ad>x</div>", "<", "</p>"])
def test_pages_without_text(page):
    assert html_extract.main_text(page).strip() in ("", "<")


LONG = "A paragraph of the page with quite a number of words in it, so that its ratio is that of content."


@pytest.mark.parametrize("before,after", [
    ('<div class="content has-sidebar">', "</div>"),
    ('<div id="ad-free-wrapper">', "</div>"),
    ('<article><section id="discussion"><h2>Discussion</h2>', "</section></article>"),
    ('<article><h2 id="related-work">Discussion</h2>', "</article>"),
    ('<article><p class="legal">Discussion</p>', "</article>"),
    ('<article><div class="entry-header"><h1>Discussion</h1></div>', "</article>"),
    ('<article class="ad-free">', "</article>"),
    ('<article><div class="entry-header"><h2>Discussion</h2></div><p>' + LONG * 9 + "</p>", "</article>"),
])
def test_class_words_only_nominate(before, after):
    page = f"<body><nav><a href=x>Home</a></nav>{before}<p>{LONG}</p><p>{LONG}</p>{after}<div class=ad>Buy</div></body>"
    want = ("Discussion " if "Discussion" in before else "") + (LONG * 9 + " " if LONG in before else "") + f"{LONG} {LONG}"
    assert html_extract.main_text(page) == want


@pytest.mark.parametrize("name", ["comments-area", "cookie-notice", "sidebar", "adSlot", "share-buttons", "related"])
def test_whole_tokens_name_boilerplate(name):
    page = f'<body><article><p>{LONG}</p><div class="x {name}"><p>Other {LONG}</p></div><p>{LONG}</p></article></body>'
    assert html_extract.main_text(page) == f"{LONG} {LONG}"


def test_nominated_links_are_dropped():
    page = f'<body><article><p>{LONG}</p><p>{LONG}</p><div class="menu"><a href=x>One</a> <a href=y>Two</a></div></article></body>'
    assert html_extract.main_text(page) == f"{LONG} {LONG}"


@pytest.mark.parametrize("page", [
    f'<body><article class="teaser"><p>Short teaser text.</p></article><div class="post"><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div></body>',
    f"<body><div><article><p>{LONG}</p></article><article><p>{LONG}</p></article></div><article><p>{LONG}</p></article></body>",
    f"<body><main><article><p>{LONG}</p><p>{LONG}</p></article><section><p>{LONG}</p></section></main></body>",
    f"<body><main><p>{LONG}</p></main><div><p>{LONG}</p><p>{LONG}</p></div></body>",
])
def test_the_clusters_choose_the_region(page):
    assert html_extract.main_text(page).replace("Short teaser text. ", "") == f"{LONG} {LONG} {LONG}"


@pytest.mark.parametrize("page", [
    f"<body><section><p>{LONG}</p>{f'<p>{LONG}</p>' * 11}</section><section><p>{LONG}</p></section></body>",
    f"<body><div>{f'<p>{LONG}</p>' * 12}</div><p>{LONG}</p></body>",
    f"<body><div><div><p>{LONG}</p></div>{f'<p>{LONG}</p>' * 12}</div></body>",
])
def test_no_content_line_is_dropped(page):
    assert html_extract.main_text(page) == " ".join([LONG] * 13)


def test_short_lines_beside_the_region_stay_out():
    page = f"<body><div>Mon 3</div><article><p>{LONG}</p><p>Hi.</p><p>{LONG}</p></article><div>Top</div></body>"
    assert html_extract.main_text(page) == f"{LONG} Hi. {LONG}"


TWO = f"<p>{LONG}</p><p>{LONG}</p>"


@pytest.mark.parametrize("page", [
    f"<body><form action=x><nav><a href=x>Home</a></nav><div>{TWO}</div><input><footer>Foot</footer></form></body>",
    f"<body><fieldset>{TWO}</fieldset></body>",
    f'<body><div class="widget">{TWO}<div class="widget">Buy more now</div></div></body>',
    f'<body><div class="modal"><div class="comments"><p>{LONG}</p></div>{TWO}</div></body>',
    f'<body><div class="page modal-open overlay"><header>Site</header>{TWO}</div></body>',
    f"<body><nav><ul><li><a href=x>Home</a><li><a href=y>News</a><article>{TWO}</article></body>",
    f'<body><article><p>{LONG}</p><div class="social"><p>{LONG}</p></div><div class="social"><a href=x>Share</a></div></article></body>',
    f'<body><article>{TWO}</article><div class="user-remarks"><p>{LONG}</p></div></body>',
    f"<body><article>{TWO}</article><form><label>Your name and a rather long explanation of it</label><p>Leave a comment.</p></form></body>",
    f"<body><article>{TWO}</article><dialog><p>{LONG}</p></dialog></body>",
])
def test_wrappers_hold_the_page_and_names_do_not_decide(page):
    assert html_extract.main_text(page) == f"{LONG} {LONG}"


@pytest.mark.parametrize("page", [
    f"<body><header><h1>Site</h1></header><main><header><h1>Headline</h1></header>{TWO}</main></body>",
    f"<body><div><h1>Headline</h1><article>{TWO}</article></div></body>",
    f"<body><h1>Site</h1><div><h1>Headline</h1></div><article>{TWO}</article></body>",
    f"<body><article><h1>Headline</h1>{TWO}</article><h1>Other</h1></body>",
])
def test_headline_of_the_region(page):
    assert html_extract.main_text(page) == f"Headline {LONG} {LONG}"


def test_smoothing_and_clusters_against_plain_loops():
    import math

    rng = random.Random(9)
    for _ in range(40):
        ratio = [rng.choice([0.0, 1.0, rng.random() * 80]) for _ in range(rng.randrange(1, 30))]
        sigma = rng.choice([0.5, 1.0, 2.3])
        r = max(1, math.ceil(sigma))
        want = []
        for i in range(len(ratio)):
            w = {j: math.exp(-((i - j) ** 2) / (2 * sigma * sigma)) for j in range(max(0, i - r), min(len(ratio), i + r + 1))}
            want.append(sum(w[j] * ratio[j] for j in w) / sum(w.values()))
        assert np.allclose(html_extract._smoothed(np.array(ratio), sigma), want)
    for _ in range(60):  # plain pages: what passes the threshold, and short lines in the region
        words = [rng.choice(["Word " * rng.randrange(8, 40), "Hi", LONG]) for _ in range(rng.randrange(3, 12))]
        page = "<body><article>" + "".join(f"<p>{w}</p>" for w in words) + "</article><div>x</div></body>"
        assert html_extract.main_text(page) == " ".join(" ".join(w.split()) for w in words)


def test_long_and_broken_pages(spark):
    big = "<article>" + "<p>word and more words here " * 40000
    assert html_extract.main_text(big) == " ".join(["word and more words here"] * 40000)
    df = spark.createDataFrame([(1, "u", PAGE, "old"), (None, None, None, None), (2, "v", "", "x"), (1, "u", PAGE, "old")], "page_id long, url string, html string, text string")
    got = html_extract.extract(df).collect()
    assert sorted(r.text for r in got) == ["", "", MAIN, MAIN]
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_extract.extract(df.where("false")).count() == 0


# ---------------------------------------------------------------- sharding
def naive_table(names, slots):
    import hashlib

    h = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:15], 16)
    off, skip = [h(f"{n}/offset") % slots for n in names], [h(f"{n}/skip") % (slots - 1) + 1 for n in names]
    own, nxt, k = [-1] * slots, [0] * len(names), 0
    while -1 in own:
        i = k % len(names)
        while own[(off[i] + nxt[i] * skip[i]) % slots] >= 0:
            nxt[i] += 1
        own[(off[i] + nxt[i] * skip[i]) % slots] = i
        nxt[i] += 1
        k += 1
    return own


@pytest.mark.parametrize("n,slots", [(1, 2), (3, 13), (7, 101), (12, 251)])
def test_lookup_table_is_filled_in_turns(spark, n, slots):
    names = [f"it's {i}" for i in range(n)]
    got = sorted((r.slot, r.shard) for r in sharding.lookup_table(spark, names, slots).collect())
    assert [s for _, s in got] == naive_table(names, slots)
    counts = Counter(s for _, s in got)
    assert max(counts.values()) - min(counts.values()) <= 1


def test_few_rows_move_when_a_shard_goes(spark):
    a, b = naive_table(sharding.shard_names(10), 1009), naive_table(sharding.shard_names(9), 1009)
    moved = sum(x != y for x, y in zip(a, b) if x != 9)
    assert moved < 0.2 * 1009


def test_placement_of_odd_rows(spark):
    docs = spark.createDataFrame(hostile_documents(n=20), DOCS).withColumnRenamed("lang", "shard").withColumnRenamed("source", "slot")
    got = sharding.place(docs, sharding.document_key(), sharding.shard_names(5), 101)
    rows = got.collect()
    assert len(rows) == docs.count() and {r.shard for r in rows} <= set(range(5)) and got.columns == ["doc_id", "text", "n_chars", "slot", "shard"]
    by_key = {}
    for r in rows:
        assert by_key.setdefault(r.doc_id if r.doc_id is not None else r.text, r.shard) == r.shard
    assert sharding.place(docs.where("false"), sharding.document_key(), sharding.shard_names(5), 101).count() == 0
    with pytest.raises(ValueError):
        sharding.lookup_table(spark, ["a", "b"], 100)


def test_columns_are_computed_in_runs_of_bounded_bytes(spark):
    """A batch of long texts is not held as strings at once, and a task leaves no freed memory with its worker."""
    docs = spark.range(64).selectExpr("id", "repeat('x', 10000) AS text").coalesce(1)

    def run(text):
        return [pa.array([len(text)] * len(text), pa.int64())]

    got = [r.n for r in append_columns(docs, ["text"], [T.StructField("n", T.LongType())], run, 100_000).collect()]
    assert len(got) == 64 and max(got) <= 10
    assert {r.n for r in append_columns(docs, ["text"], [T.StructField("n", T.LongType())], run).collect()} == {64}


def test_a_worker_gives_memory_back_after_its_task():
    code = """
import re
import numpy as np, pyarrow as pa
from turnloom.llm.common import lean

def held():
    return int(re.search(r"VmRSS:\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024

def run(batches):
    for b in batches:
        kept = [np.ones(10_000) for _ in range(1500)]
        pinned.append(np.ones(10_000))  # lies behind them: freed memory does not go back by itself
        yield b
        del kept

pinned = []
before = held()
for _ in lean(run)([1]):
    most = held()
print(before, most, held())
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    before, most, after = map(float, out.stdout.split())
    assert most - before > 100 and after - before < 30


def test_profiles_do_not_depend_on_the_bytes_read_at_once(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a = langid.learn(docs)
    monkeypatch.setattr(langid, "_BYTES_AT_ONCE", 5000)
    monkeypatch.setattr(langid, "_CHARS_AT_ONCE", 700)
    b = langid.learn(docs)
    assert a.langs == b.langs and (a.grams == b.grams).all() and (a.ranks == b.ranks).all()
    rows = lambda p: sorted((r.doc_id, r.lang_pred, r.score) for r in langid.identify(docs, p).collect())
    got = rows(b)
    monkeypatch.undo()
    assert got == rows(a)

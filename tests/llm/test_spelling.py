"""Spelling variants against all pairs by plain edit distance."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.data import DOCS, hostile_documents
from turnloom.llm import spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    if len(a) == len(b):
        return a[p + 1 :] == b[p + 1 :]
    return a[p + 1 :] == b[p:] if len(a) > len(b) else a[p:] == b[p + 1 :]


def plain(rows, min_letters=7, min_count=2, ratio=10):
    n = Counter()
    for r in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", r[1] or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    n = {w: k for w, k in n.items() if len(w) >= min_letters and k >= min_count}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def run(spark, rows, **kw):
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("source", "word").withColumnRenamed("lang", "n")
    return sorted(tuple(r) for r in spelling.spelling_variants(docs, **kw).select("word", "form", "root", "n", "n_near", "form_n").collect())


def corpus(seed=2, n=400):
    rng = random.Random(seed)
    syllable = ["an", "the", "ré", "ion", "ti", "er", "ÀÉ", "ou", "Ma", "en"]
    vocab = ["".join(rng.choice(syllable) for _ in range(rng.randrange(2, 5))) for _ in range(150)]
    rows = []
    for i in range(n):
        words = [vocab[min(int(rng.paretovariate(0.6)), 149)] for _ in range(40)]
        for k in range(len(words)):
            if rng.random() < 0.1 and len(words[k]) > 3:
                at = rng.randrange(len(words[k]))
                words[k] = words[k][:at] + rng.choice(["", "x", "é"]) + words[k][at + rng.randrange(2) :]
        rows.append((i, ", ".join(words), "en", "s", 1))
    rows += [(9100 + i, f"{w} " * k, "en", "s", 1) for i, (w, k) in enumerate([("chainword", 2000), ("chainwordy", 100), ("chainwordyz", 5)])]
    return rows + hostile_documents(n=10) + [(-5, None, None, None, None), (None, "Überraschung überraschung ÜBERRASCHUNG x" * 3, None, None, None)]


def test_against_all_pairs(spark):
    rows = corpus()
    want = plain(rows)
    assert sum(w[1] is not None for w in want) > 50 and any(w[1] not in (None, w[2]) for w in want)
    assert run(spark, rows) == want


def test_large_groups_are_dealt_anew(spark, monkeypatch):
    """Groups above the limit go through every level and the last join; nothing is lost."""
    rows = corpus(5, 150)
    words = spark.createDataFrame([(w[0],) for w in plain(rows)], "word string")
    want = sorted((w.word, x.word) for w in words.collect() for x in words.collect() if w.word < x.word and one_edit(w.word, x.word))
    for limit, levels in ((1, (3, 4)), (2, (4, 8, 16)), (3, (3,))):
        got = sorted((r.x, r.y) for r in spelling.near_pairs(words, levels, limit).collect())
        assert got == want


def test_pieces_cut_no_word(spark, monkeypatch):
    monkeypatch.setattr(spelling, "_CHARS_AT_ONCE", 5)
    monkeypatch.setattr(spelling, "_WORDS_AT_ONCE", 3)
    rows = corpus(7, 40)
    assert run(spark, rows) == plain(rows)


@pytest.mark.parametrize("parts", [3, 4, 8])
def test_near_words_share_a_signature(parts):
    rng = random.Random(parts)
    for _ in range(300):
        a = "".join(rng.choice("abcdé") for _ in range(rng.randrange(7, 14)))
        at = rng.randrange(len(a))
        b = a[:at] + rng.choice(["", "z", "a", "zz"]) + a[at + rng.randrange(2) :]
        if not one_edit(a, b):
            continue
        cp, size = spelling._code_points([a, b])
        keys = [set(), set()]
        for sig in spelling.signatures(cp, size, parts):
            for rows, half in spelling.half_keys(cp, size):
                for i, k in zip(rows.tolist(), (half ^ sig[rows]).tolist()):
                    keys[i].add(k)
        assert keys[0] & keys[1], (a, b)


def test_long_text_and_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, None, None, None), (2, "short words only", None, None, None)]) == []
    long = [(1, "wonderful " * 200_000 + "wonderfull " * 2, "en", "s", 1), (2, "a" * 300_000, "en", "s", 1)]
    assert run(spark, long) == plain(long)

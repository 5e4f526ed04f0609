"""Katz backoff against a plain dictionary model."""

import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.data import DOCS, hostile_documents
from turnloom.llm import katz


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w] + ["<e>"]


class Plain:
    """Counts in dictionaries, weights summed over all successors of a history."""

    def __init__(self, texts, order, cutoff):
        self.order, self.counts = order, [Counter() for _ in range(order + 1)]
        for t in texts:
            seq = ["<s>", *tokens(t)]
            for i in range(1, len(seq)):
                for o in range(1, order + 1):
                    if i - o + 1 >= 0:
                        self.counts[o][tuple(seq[i - o + 1 : i + 1])] += 1
        self.followers = {}
        for o in range(1, order + 1):
            for g in self.counts[o]:
                self.followers.setdefault(g[:-1], []).append(g[-1])
        self.d = [None]
        for o in range(1, order + 1):
            by = Counter(self.counts[o].values())
            self.d.append(katz.good_turing([by[r] for r in range(1, cutoff + 2)], cutoff))
        self.cutoff = cutoff
        self.memo = {}

    def disc(self, g):
        r = self.counts[len(g)][g]
        return self.d[len(g)][min(r, self.cutoff + 1)] * r

    def total(self, h):
        n = sum(self.counts[len(h) + 1][(*h, w)] for w in self.followers.get(h, []))
        return n if self.left(h) > 0 or not self.followers.get(h) and h else n + 1

    def left(self, h):
        return sum(self.counts[len(h) + 1][(*h, w)] - self.disc((*h, w)) for w in self.followers.get(h, []))

    def alpha(self, h):
        if h not in self.memo:
            n = self.total(h)
            rest = self.left(h) if self.left(h) > 0 else 1
            self.memo[h] = rest / n / (1 - sum(self.p(h[1:], w) for w in self.followers[h]))
        return self.memo[h]

    def p(self, h, w):
        if not h:
            if self.counts[1][(w,)]:
                return self.disc((w,)) / self.total(h)
            return (self.left(h) if self.left(h) > 0 else 1) / self.total(h)
        if h not in self.followers:
            return self.p(h[1:], w)
        if self.counts[len(h) + 1][(*h, w)]:
            return self.disc((*h, w)) / self.total(h)
        return self.alpha(h) * self.p(h[1:], w)

    def score(self, text):
        seq = ["<s>", *tokens(text)]
        return sum(math.log10(self.p(tuple(seq[max(0, i - self.order + 1) : i]), seq[i])) for i in range(1, len(seq)))


def corpus(seed=3, n=80):
    rng = random.Random(seed)
    vocab = [f"w{int(rng.paretovariate(0.7))}" for _ in range(500)]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 60))), "en", "s", 1) for i in range(n)]
    return rows + hostile_documents(n=12)


def check(spark, rows, order, cutoff=5):
    docs = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("x")).withColumn("row", F.lit(1)).withColumn("train", F.lit(None))
    got = katz.katz_scores(docs, ~katz.held_out(), order=order, cutoff=cutoff).collect()
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows]
    m = Plain([r[1] for r, x in zip(rows, held) if not x], order, cutoff)
    n, v = sum(m.counts[1].values()), len(m.counts[1])
    want = []
    for r, x in zip(rows, held):
        t = tokens(r[1])
        c = [m.counts[1][(w,)] for w in t]
        want.append((r[0], not x, len(t), sum(k > 0 for k in c), n, sum(math.log10((k + 0.1) / (n + 0.1 * (v + 1))) for k in c), m.score(r[1])))
    key = lambda r: (str(r[0]), r[2], r[6])
    got = sorted(((r.doc_id, r.trained, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want, key=key)):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], abs=1e-9) and a[6] == pytest.approx(b[6], abs=1e-8)
    return m


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_plain_model(spark, order):
    check(spark, corpus(), order)


def test_probabilities_sum_to_one():
    m = Plain([r[1] for r in corpus()], 3, 5)
    words = [w for (w,) in m.counts[1]]
    for h in list(m.followers)[::40]:
        assert sum(m.p(h, w) for w in words) + m.p(h, "never seen") == pytest.approx(1, abs=1e-9)


def test_pieces_blocks_and_buckets(spark, monkeypatch):
    """One text over many pieces, many blocks and buckets give the same results."""
    monkeypatch.setattr(katz, "PIECE", 7)
    monkeypatch.setattr(katz, "BLOCK", 64)
    monkeypatch.setattr(katz, "BUCKET_TOKENS", 300)
    monkeypatch.setattr(katz, "_BYTES_AT_ONCE", 11)
    rows = corpus(9, 30) + [(i, "a b " * 200, "en", "s", 1) for i in range(700, 712)]
    check(spark, rows, 3)


def test_long_text(spark):
    rows = [(1, " ".join(f"k{i * i % 2999}" for i in range(3_000_000)), "en", "s", 1), (2, "k1 k2 k3", "en", "s", 1)]
    got = {r.doc_id: r for r in katz.katz_scores(spark.createDataFrame(rows, DOCS), ~katz.held_out()).collect()}
    assert got[1].n_tokens == 3_000_001 and got[1].score > got[1].base_score


def test_no_rows_and_no_training(spark):
    empty = spark.createDataFrame([], DOCS)
    assert katz.katz_scores(empty, ~katz.held_out()).collect() == []
    docs = spark.createDataFrame([(1, "a b", None, None, None), (2, None, None, None, None)], DOCS)
    got = sorted(katz.katz_scores(docs, F.lit(False)).collect())
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0)]


def test_good_turing_needs_values_between_zero_and_one():
    assert katz.good_turing([0] * 6, 5).tolist() == [0.0, 0.5, 0.75, 2.5 / 3, 3.5 / 4, 0.9, 1.0]
    d = katz.good_turing([1000, 300, 150, 90, 60, 40], 5)
    assert all(0 < x < 1 for x in d[1:6]) and d[6] == 1


def test_held_out_scores_beat_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = katz.katz_scores(docs, ~katz.held_out()).where("NOT trained").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]

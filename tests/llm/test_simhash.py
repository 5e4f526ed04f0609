import re

import numpy as np
import xxhash

from tests.llm.data import DOCS, hostile_documents
from turnloom.llm import simhash
from turnloom.llm.common import connected_components


def naive_fingerprint(text, k=3):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    sh = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hs) > len(hs))


def naive_components(codes, max_bits):
    label = list(range(len(codes)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= max_bits:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


def test_whole_operator_against_brute_force(spark):
    rows = hostile_documents()
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("lang", "fp").withColumnRenamed("source", "component_id")
    got = simhash.simhash_components(docs).collect()
    codes = [naive_fingerprint(r[1]) for r in rows]
    comp = naive_components(codes, 2)
    low = {}
    for r, c in zip(rows, comp):
        if r[0] is not None:
            low[c] = min(low.get(c, r[0]), r[0])
    want = sorted(((r[0], f, low.get(c)) for r, f, c in zip(rows, codes, comp)), key=str)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=str) == want


def test_empty_table(spark):
    assert simhash.simhash_components(spark.createDataFrame([], DOCS)).count() == 0
    assert simhash.keep_one(spark.createDataFrame([], DOCS)).count() == 0


def test_keep_one_keeps_one_row_of_each_component(spark):
    rows = hostile_documents()
    docs = spark.createDataFrame(rows, DOCS)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    comp = naive_components([naive_fingerprint(r[1]) for r in rows], 2)
    assert kept.count() == len(set(comp))
    by_fp = [naive_fingerprint(r.text) for r in kept.collect()]
    assert len(set(naive_components(by_fp, 2))) == len(by_fp)


def test_links_of_dense_groups_with_refinement(spark):
    """A ball of close codes and random ones; a tiny group limit forces several rounds of dealing."""
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 1 << 63))
    codes = {centre}
    for _ in range(300):
        codes.add(centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 5), replace=False)))
    codes |= {int(x) for x in rng.integers(0, 1 << 63, 200)}
    codes = sorted(codes)
    signed = [(c - (1 << 64) if c >> 63 else c,) for c in codes]
    fps = spark.createDataFrame(signed, "fp long")
    want = naive_components(codes, 2)
    for limit in (16, 64, 4096):
        edges = simhash.close_links(fps, 2, group_limit=limit)
        assert all((e.u % 2**64 ^ e.v % 2**64).bit_count() >= 1 for e in edges.collect())
        comp = {r.node % 2**64: r.component for r in connected_components(edges).collect()}
        groups = {}
        for c, w in zip(codes, want):
            groups.setdefault(w, set()).add(comp.get(c, ("alone", c)))
        assert all(len(g) == 1 for g in groups.values())
        assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_gray_index_finds_all_pairs():
    rng = np.random.default_rng(4)
    codes = np.unique(rng.integers(0, 1 << 12, 700).astype(np.uint64))

    def rank(x):
        for s in (1, 2, 4, 8, 16, 32):
            x ^= x >> s
        return x

    codes = codes[np.argsort([rank(int(c)) for c in codes])]
    i, j = simhash.GrayIndex(codes).close_pairs(2)
    got = set(zip(i.tolist(), j.tolist()))
    want = {(a, b) for a in range(len(codes)) for b in range(a + 1, len(codes)) if int(codes[a] ^ codes[b]).bit_count() <= 2}
    assert got == want


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(0, 400)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000), (7, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[i] for i in range(401)} == {0}
    assert {got[1000 + i] for i in range(300)} == {1000}


def test_texts_do_not_come_back_from_the_workers(spark):
    """The fingerprints of many slices of texts, without the texts."""
    rows = hostile_documents() + [(5000 + i, f"w{i} " * 3000, "en", "s", 1) for i in range(900)]
    docs = spark.createDataFrame(rows, DOCS).coalesce(1)
    got = simhash.with_fingerprint(docs.select("doc_id", "text"), drop=("text",))
    assert got.columns == ["doc_id", "fp"]
    assert sorted(((r.doc_id, r.fp % (1 << 64)) for r in got.collect()), key=str) == sorted(((r[0], naive_fingerprint(r[1])) for r in rows), key=str)

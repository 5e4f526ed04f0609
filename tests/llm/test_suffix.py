import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.data import DOCS, hostile_documents
from turnloom.llm import suffix_array as A, suffix_dedup as S


def naive(texts, span):
    seen = {}
    data = [(t or "").encode() for t in texts]
    for b in data:
        for i in range(len(b) - span + 1):
            seen[b[i : i + span]] = seen.get(b[i : i + span], 0) + 1
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - span + 1):
            if seen[b[i : i + span]] > 1:
                gone[i : i + span] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_suffix_array(seed):
    rng = np.random.default_rng(seed)
    for _ in range(60):
        k = int(rng.integers(1, 5))
        t = np.append(rng.integers(1, k + 1, rng.integers(0, 80)), 0).astype(np.int16)
        if seed % 2 and len(t) > 8:
            t = np.append(np.tile(t[: len(t) // 4], 5), 0).astype(np.int16)
            t[:-1] = np.maximum(t[:-1], 1)
        assert A.suffix_array(t, k + 1).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


def test_recursion_and_doubling_agree(monkeypatch):
    rng = np.random.default_rng(8)
    base = rng.integers(1, 4, 30)
    t = np.append(np.concatenate([base if rng.random() < 0.6 else rng.integers(1, 4, 9) for _ in range(80)]), 0).astype(np.int16)
    want = sorted(range(len(t)), key=lambda i: t[i:].tolist())
    for ratio in (1, 10**9):
        monkeypatch.setattr(A, "_INDUCE_RATIO", ratio)
        assert A.suffix_array(t, 4).tolist() == want


def test_repeated_windows_of_a_shard():
    rng = random.Random(2)
    parts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(10, 60))) for _ in range(30)]
    parts.append(parts[0] + b"a")
    n = [max(1, len(p) - 8 + 1) for p in parts]
    got = S.repeated_windows(parts, n, span=8)
    count = {}
    for p, m in zip(parts, n):
        for i in range(m):
            count[p[i : i + 8]] = count.get(p[i : i + 8], 0) + 1
    for p, m, g in zip(parts, n, got):
        assert g.tolist() == [count[p[i : i + 8]] > 1 for i in range(m)]


@pytest.mark.parametrize("shard", [None, 600])
def test_operator_against_brute_force(spark, shard):
    """The small shard makes every group hot, so names are refined to whole windows."""
    rng = random.Random(6)
    rows = hostile_documents()
    common = " ".join(f"c{rng.randrange(999)}" for _ in range(30))  # under 200 bytes, in many texts
    rows += [(700 + i, " ".join(f"q{rng.randrange(9999)}" for _ in range(25)) + " " + common[:150] + " " + " ".join(f"q{rng.randrange(9999)}" for _ in range(25)), "en", "s", 1) for i in range(25)]
    rows += [(800 + i, rows[10][1] * 3 + common * 2 + str(i) * (i * 40), "en", "s", 1) for i in range(6)]
    rows = [r for r in rows if r[0] is not None or r[1] is not None]
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("lang", "k1").withColumnRenamed("source", "data")
    kw = {} if shard is None else {"shard_bytes": shard}
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.dedup(docs, **kw).collect()), key=str)
    want = sorted(((r[0], *w[:4]) for r, w in zip(rows, naive([r[1] for r in rows], 200))), key=str)
    assert got == want
    assert sum(w[2] > 0 for w in want) > 10


def test_cleaned_texts_and_empty_table(spark):
    rows = hostile_documents()
    docs = spark.createDataFrame(rows, DOCS)
    got = S.cleaned(docs)
    assert got.columns == docs.columns
    want = sorted([(r[0], None if r[1] is None else w[4].decode("utf-8", "ignore")) for r, w in zip(rows, naive([r[1] for r in rows], 200))], key=str)
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=str) == want
    assert S.dedup(docs.where("false")).count() == 0
    assert S.cleaned(docs.where("false")).count() == 0


def test_cleaned_in_slices_and_one_python_pass(spark, monkeypatch):
    """Few bytes at once give the same texts, and the cut texts pass one worker, not two in a row."""
    monkeypatch.setattr(S, "_BYTES_AT_ONCE", 300, raising=False)
    rows = hostile_documents()
    got = S.cleaned(spark.createDataFrame(rows, DOCS))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    want = sorted([(r[0], None if r[1] is None else w[4].decode("utf-8", "ignore")) for r, w in zip(rows, naive([r[1] for r in rows], 200))], key=str)
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=str) == want


def test_small_groups_share_small_suffix_arrays(spark, monkeypatch):
    """What a task sorts at once is bounded by ``PACK_BYTES`` and one group, and holds whole groups."""
    docs, given, sizes = spark.createDataFrame([(1,)], "x int"), [], []
    with monkeypatch.context() as m:
        m.setattr(type(docs), "mapInArrow", lambda self, run, schema: given.append(run))
        S._search(docs, 200, getattr(S, "PACK_BYTES", S.SHARD_BYTES))
    inner = S.repeated_windows
    monkeypatch.setattr(S, "repeated_windows", lambda parts, n, span: sizes.append(sum(map(len, parts))) or inner(parts, n, span))
    rng = random.Random(9)
    rows = [(h, i, 50, 0, rng.randbytes(249)) for h in range(1500) for i in range(4)]
    rows += [(h, 4, 50, 0, p) for h, _, _, _, p in rows[2::4]]  # one segment of each group comes twice
    rows.sort(key=lambda r: r[:2])
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[a : a + 1000])], ["h", "seg", "n", "c0", "part"]) for a in range(0, len(rows), 1000)]
    found = [r for b in given[0](iter(batches)) for r in zip(*[c.to_pylist() for c in b.columns])]
    assert sorted(found) == [(h, s, 50, 0, 0, 50) for h in range(1500) for s in (2, 4)]
    assert len(sizes) > 2 and max(sizes) <= 600_000

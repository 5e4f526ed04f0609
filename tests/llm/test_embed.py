import numpy as np

from turnloom.llm import embed_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int, extra string"


def naive(rows, threshold):
    valid = []
    for i, (_, v, lab, _) in enumerate(rows):
        ok = lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        valid.append(np.array(v, np.float32).astype(float) if ok else None)
    n, label = len(rows), list(range(len(rows)))
    links = [0] * n

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(n):
        for j in range(i):
            a, b = valid[i], valid[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                links[i] += 1
                links[j] += 1
                label[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return sorted(((r[0], links[i], low.get(find(i)), r[0] == low.get(find(i))) for i, r in enumerate(rows)), key=str)


def run(spark, rows, **kw):
    got = E.near_dedup(spark.createDataFrame(rows, SCHEMA).withColumnRenamed("extra", "node"), **kw).collect()
    return sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in got], key=str)


def rows_of(seed, n=250, dim=12):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dim))
    rows = [(i, base[i].tolist(), int(i % 3), "x") for i in range(n)]
    for i in range(40):  # one dense family, larger than a neighbour list
        rows.append((1000 + i, (base[0] + 0.02 * rng.standard_normal(dim)).tolist(), 0, "x"))
    for i in range(12):  # a chain
        rows.append((1100 + i, (base[1] * np.cos(i * 0.15) + base[2] / np.linalg.norm(base[2]) * np.linalg.norm(base[1]) * np.sin(i * 0.15)).tolist(), 1, "x"))
    rows += [(1200 + i, base[3].tolist(), 0, "x") for i in range(5)]  # copies
    rows += [(1210, (base[3] * 7).tolist(), 0, "x"), (1211, base[3].tolist(), 1, "x"), (1212, base[3].tolist(), None, "x")]
    rows += [(1220, None, 0, "x"), (1221, [], 0, "x"), (1222, [0.0] * dim, 0, "x"), (1223, [float("nan")] + [1.0] * (dim - 1), 0, "x")]
    rows += [(1224, [None] + base[3].tolist(), 0, "x"), (1225, [float("inf")] * dim, 0, "x"), (1226, base[3].tolist()[:5], 0, "x"), (None, base[4].tolist(), 1, None)]
    rows += [(1227, [1e-30] * dim, 2, "x"), (1228, [1e30] * dim, 2, "x"), rows[7], rows[7]]
    return rows


def test_against_brute_force(spark):
    rows = rows_of(1)
    assert run(spark, rows) == naive(rows, 0.98)


def test_small_tiles_and_lists(spark, monkeypatch):
    monkeypatch.setattr(E, "TILE", 16)
    rows = rows_of(2, n=120)
    assert run(spark, rows, size=4, threshold=0.9) == naive(rows, 0.9)


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(5, None, 1, "x")]) == [(5, 0, 5, True)]


def bridged(n, dim=12, seed=5):
    """Two families around a circle, too tight for a list to leave its family, one link between them."""
    rng = np.random.default_rng(seed)
    degrees = [*rng.uniform(0, 1.5, n), 2.0, 13.2, *rng.uniform(13.9, 15, n)]
    x = 1e-4 * rng.standard_normal((len(degrees), dim))
    x[:, 0] += np.cos(np.radians(degrees))
    x[:, 1] += np.sin(np.radians(degrees))
    return [(i, v.tolist(), 1, "x") for i, v in zip(rng.permutation(len(x)).tolist(), x)]


def test_links_that_full_lists_keep_out(spark):
    rows = bridged(300) + [(2000 + i, v, 2, "x") for i, (_, v, _, _) in enumerate(bridged(20))]
    got = run(spark, rows)
    assert got == naive(rows, 0.98) and len({r[2] for r in got if r[0] < 2000}) == 1


def test_missed_audit_is_made_good(spark, monkeypatch):
    """No refinement and bad starting runs: the exact pass finds every link, in small blocks too."""
    monkeypatch.setattr(E, "RUN", 2)
    monkeypatch.setattr(E, "CELLS", 16, raising=False)
    monkeypatch.setattr(E, "TILE", 16)
    rows = rows_of(3, n=100)
    assert run(spark, rows, size=2, projections=1, rounds=0) == naive(rows, 0.98)

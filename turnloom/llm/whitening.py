"""Embedding whitening by spectrum slicing.

Each component ``c`` of a vector becomes the integer ``x = floor(64 c) + 1000000``. The
covariance is taken over the distinct ``x`` vectors (the fit list) and stays exact until
its last rounding: one pass sums ``x``, a second sums the products of ``x - round(mean)``
as integers (small enough for exact double products), and the rest of the mean is taken
off in integers. Tasks emit d x d partial sums each; what reaches the driver is one
d x d matrix, whatever the number of rows.

Spectrum slicing (driver, d x d): the LDL^T factors of ``V - s I`` (symmetric pivoting
with 1 x 1 and 2 x 2 blocks) have as many positive eigenvalues as ``V`` has eigenvalues
above ``s``. Bisection with these counts isolates each leading eigenvalue; inverse
iteration in its interval and Rayleigh quotient iteration, which converges cubically,
give the pair; two more counts, just above and just below the quotient, certify that it
is the eigenvalue of that number. Eigenvalues that no count can tell apart in double
precision are certified together, their vectors kept orthogonal. If some can hardly be told
apart, so that this fails, those within eight times the error of a count are one group:
inverse iteration with as many vectors at once and Rayleigh-Ritz finds them, and two counts
certify the group.

A third pass over the fit list measures the covariance of the whitened vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import ship_by_value
from .common import drop_table, write_table

ship_by_value(__name__)

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
LIMIT = float(1 << 46)  # |64 c| above this has no exact sums of squares: such rows are dropped
_EXACT = float(1 << 53)
_EPS = np.finfo(float).eps


# ---------------------------------------------------------------- inertia and eigenpairs of one matrix
def ldl_factors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]], np.ndarray]:
    """``a[p][:, p] = L D L^T`` with blocks of one or two rows in D: ``(L, D, blocks, p)``.
    The pivot is the largest diagonal entry, or a pair of rows if an entry off the
    diagonal is much larger than every diagonal one."""
    n = len(a)
    a = a.copy()
    low, d, p = np.eye(n), np.zeros((n, n)), np.arange(n)
    blocks, k, alpha = [], 0, (1 + 17**0.5) / 8

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]
            low[[i, j], :k] = low[[j, i], :k]
            p[[i, j]] = p[[j, i]]

    while k < n:
        rest = np.abs(a[k:, k:])
        diag = int(rest.diagonal().argmax())
        top = rest[diag, diag]
        off = np.triu(rest, 1)
        at = int(off.argmax())
        i, j = divmod(at, n - k)
        if top >= alpha * off[i, j] or k == n - 1:
            swap(k, k + diag)
            size = 1
        else:
            swap(k, k + i)
            swap(k + 1, k + j)
            size = 2
        piv = a[k : k + size, k : k + size].copy()
        d[k : k + size, k : k + size] = piv
        if k + size < n:
            c = a[k + size :, k : k + size]
            if size == 1:
                f = c / piv[0, 0] if piv[0, 0] != 0 else np.zeros_like(c)
            else:
                f = c @ np.linalg.inv(piv)
            low[k + size :, k : k + size] = f
            a[k + size :, k + size :] -= f @ c.T
        blocks.append((k, size))
        k += size
    return low, d, blocks, p


def count_above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of ``v`` are above ``shift`` (Sylvester's law of inertia)."""
    _, d, blocks, _ = ldl_factors(v - shift * np.eye(len(v)))
    n = 0
    for k, size in blocks:
        if size == 1:
            n += d[k, k] > 0
        else:  # a block of two rows: by its determinant and trace
            det = d[k, k] * d[k + 1, k + 1] - d[k, k + 1] ** 2
            n += 1 if det < 0 else 2 * (d[k, k] + d[k + 1, k + 1] > 0)
    return int(n)


def _solve(v: np.ndarray, shift: float, x: np.ndarray) -> np.ndarray:
    """``(v - shift I)^-1 x`` (a vector, or columns) by the same factors; a zero pivot becomes a
    rounding error."""
    tiny = _EPS * max(np.abs(v).max(), np.finfo(float).tiny)
    low, d, blocks, p = ldl_factors(v - shift * np.eye(len(v)))
    y = x[p].copy()
    for k in range(len(y)):
        y[k + 1 :] -= np.multiply.outer(low[k + 1 :, k], y[k])
    for k, size in blocks:
        if size == 1:
            y[k] /= d[k, k] if abs(d[k, k]) > tiny else tiny
        else:
            y[k : k + 2] = np.linalg.solve(d[k : k + 2, k : k + 2], y[k : k + 2])
    for k in range(len(y) - 1, -1, -1):
        y[k] -= low[k + 1 :, k] @ y[k + 1 :]
    out = np.empty_like(y)
    out[p] = y
    return out


def _one_by_one(v: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Each eigenvalue in an interval of its own; a cluster if no count can tell some apart."""
    d = len(v)
    norm = float(np.abs(v).sum(1).max()) if d else 0.0
    gap = 32 * d * _EPS * norm  # counts cannot tell nearer eigenvalues apart
    floor = 4 * gap
    rank = count_above(v, floor) if norm > 0 else 0
    top = min(top, rank)
    values, vectors = np.zeros(top), np.zeros((d, top))
    known = {floor: rank, norm * (1 + 1e-12): 0}  # counts at the shifts tried so far
    rng = np.random.default_rng(12)

    def above(s: float) -> int:
        if s not in known:
            known[s] = count_above(v, s)
        return known[s]

    k = 0
    while k < top:
        a = max(s for s, c in known.items() if c >= k + 1)
        b = min(s for s, c in known.items() if c <= k)
        while above(a) - above(b) > 1 and b - a > gap:
            m = (a + b) / 2
            if above(m) >= k + 1:
                a = m
            else:
                b = m
        if b - a <= gap:  # a cluster: as many pairs as the counts say, kept orthogonal
            width = min(above(a), top) - k
        else:
            width = 1
        for t in range(k, k + width):
            while True:
                x = rng.standard_normal(d)
                shift = (a + b) / 2
                for step in range(60):
                    x = _solve(v, shift, x)
                    for _ in range(2):
                        x -= vectors[:, :t] @ (vectors[:, :t].T @ x)
                    x /= np.sqrt(x @ x)
                    rho = float(x @ v @ x)
                    err = float(np.sqrt(((v @ x - rho * x) ** 2).sum()))
                    if err <= gap:
                        break
                    if step >= 2 and a <= rho <= b:
                        shift = rho
                inside = a - gap <= rho <= b + gap
                if err <= gap and inside:
                    break
                m = (a + b) / 2  # the quotient went to a neighbour: a narrower interval
                if not a < m < b:
                    raise ArithmeticError(f"eigenvalue {t + 1} was not found")
                if above(m) >= t + 1:
                    a = m
                else:
                    b = m
            values[t], vectors[:, t] = rho, x
        slack = 2 * gap
        if not above(values[k] + slack) <= k or not above(values[k + width - 1] - slack) >= k + width:
            raise ArithmeticError(f"counts do not confirm eigenvalue {k + 1}")
        k += width
    return values, vectors


def _in_groups(v: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues that are hardly apart are sought as one group, and certified as one."""
    d = len(v)
    norm = float(np.abs(v).sum(1).max()) if d else 0.0
    gap = 32 * d * _EPS * norm  # counts cannot tell nearer eigenvalues apart
    room = 8 * gap  # nearer ones are one group: the vectors of a group are sought at once
    close = gap / 8  # residual of a vector, but for what the vectors before it leave open
    floor = 4 * gap
    rank = count_above(v, floor) if norm > 0 else 0
    top = min(top, rank)
    values, vectors = np.zeros(top), np.zeros((d, top))
    known = {floor: rank, norm * (1 + 1e-12): 0, -norm * (1 + 1e-12): d}  # counts at the shifts tried so far
    rng = np.random.default_rng(12)

    def above(s: float) -> int:
        if s not in known:
            known[s] = count_above(v, s)
        return known[s]

    def bounds(k: int) -> tuple[float, float]:
        """What the counts say of eigenvalue ``k`` (from 0)."""
        a, b = max(s for s, c in known.items() if c > k), min(s for s, c in known.items() if c <= k)
        return (a, b) if a < b else ((a + b) / 2,) * 2  # counts that contradict each other: it is there

    def halve(k: int) -> None:
        above(sum(bounds(k)) / 2)

    def apart(k: int) -> bool:
        """Are eigenvalues ``k`` and ``k + 1`` further apart than ``room``? (If in doubt by two gaps: no.)"""
        while True:
            (a, b), (low, high) = bounds(k), bounds(k + 1)
            if a - high >= room:
                return True
            if b - low <= room + 2 * gap:
                return False
            halve(k if b - a >= high - low else k + 1)

    k = 0
    while k < top:
        width = 1
        while k + width < d and not apart(k + width - 1):
            width += 1
        if width > 1:
            for t in (k, k + width - 1):  # both ends of a group, as near as counts go
                while np.ptp(bounds(t)) > gap:
                    halve(t)
        done = vectors[:, :k]
        while True:
            a, b = bounds(k + width - 1)[0], bounds(k)[1]
            x, shift = rng.standard_normal((d, width)), (a + b) / 2
            for step in range(60 * width):
                x = _solve(v, shift, x)
                x /= np.sqrt((x * x).sum(0))
                for _ in range(2):
                    x = np.linalg.qr(x - done @ (done.T @ x))[0]
                inner = x.T @ v @ x  # of a group: the best vectors of the space that it spans
                rho, turn = np.linalg.eigh((inner + inner.T) / 2)
                rho, x = rho[::-1], x @ turn[:, ::-1]
                off = v @ x - x * rho
                off -= done @ (done.T @ off)
                err = float(np.sqrt((off * off).sum(0)).max())
                if err <= close:
                    break
                if width == 1 and step >= 2 and a <= rho[0] <= b:
                    shift = float(rho[0])
            if err <= close and a - gap <= rho[-1] and rho[0] <= b + gap:
                break
            if width > 1 or b - a <= gap:
                raise ArithmeticError(f"eigenvalue {k + 1} was not found")
            halve(k)  # the quotient went to a neighbour: a narrower interval
        slack = 2 * gap
        if not above(rho[0] + slack) <= k or not above(rho[-1] - slack) >= k + width:
            raise ArithmeticError(f"counts do not confirm eigenvalue {k + 1}")
        some = min(width, top - k)
        values[k : k + some], vectors[:, k : k + some] = rho[:some], x[:, :some]
        k += width
    return values, vectors


def leading_eigenpairs(v: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``top`` largest positive eigenvalues, falling, and their unit vectors as columns.

    Fewer come back if fewer are above rounding errors (rank). The sign of a vector makes
    its largest entry positive. Raises if the counts do not confirm an eigenvalue's number.
    """
    try:
        values, vectors = _one_by_one(v, top)
    except ArithmeticError:  # eigenvalues about as near as the error of a count
        values, vectors = _in_groups(v, top)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    for t in range(len(values)):
        if vectors[np.abs(vectors[:, t]).argmax(), t] < 0:
            vectors[:, t] *= -1
    return values, vectors


# ---------------------------------------------------------------- integer vectors
def _valid(col: str) -> str:
    return f"{col} IS NOT NULL AND forall({col}, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c * {SCALE}D) < {LIMIT:.1f}D)"


def _groups(col: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, rows, x)`` for the vectors of each length in a list column."""
    size = np.asarray(pa.compute.list_value_length(col))
    flat = np.asarray(pa.compute.list_flatten(col).cast(pa.float64()))
    start = np.cumsum(size) - size
    for d in np.unique(size).tolist():
        rows = np.flatnonzero(size == d)
        c = flat[start[rows][:, None] + np.arange(d)] if d else np.zeros((len(rows), 0))
        yield d, rows, np.floor(c * SCALE).astype(np.int64) + SHIFT


def _pack(x: np.ndarray) -> bytes:
    return x.astype("<i8").tobytes()


def _unpack(col: pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), "<i8").reshape(len(col), d)


def _mean(total: int, n: int) -> int:
    """``total / n``, rounded."""
    return (2 * total + n) // (2 * n)


def _column_sums(x: np.ndarray) -> np.ndarray:
    """Exact: entries are below 2**47, so 2**15 of them have a sum below 2**62."""
    return sum((x[a : a + (1 << 15)].sum(0).astype(object) for a in range(0, len(x), 1 << 15)), np.zeros(x.shape[1], object))


def _row_squares(y: np.ndarray) -> list[int]:
    """The exact sum of squares of each row, from halves of 25 bits if 64 bits do not hold it."""
    most, d = int(np.abs(y).max(initial=0)), max(y.shape[1], 1)
    if most * most * d < 1 << 62:
        return (y * y).sum(1).tolist()
    if most >= 1 << 50 or d >= 1 << 11:
        return [int(sum(v * v for v in r)) for r in y.astype(object)]
    high, low = y >> 25, y & ((1 << 25) - 1)
    parts = zip((high * high).sum(1).tolist(), (high * low).sum(1).tolist(), (low * low).sum(1).tolist())
    return [(a << 50) + (b << 26) + c for a, b, c in parts]


@dataclass(frozen=True)
class Fit:
    """One vector length: number of fit vectors, exact sums, eigenvalues and vectors."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """``x - S/n`` in double, and the exact sum of squares of ``n x - S`` of each row."""
        mid = [_mean(v, self.n) for v in self.sums]
        off = [v - self.n * m for v, m in zip(self.sums, mid)]
        z = x - np.array(mid, np.int64)
        if (int(np.abs(z).max(initial=0)) + 1) * self.n < 1 << 62:
            y = z * self.n - np.array(off, np.int64)  # n x - S
            return y / self.n, _row_squares(y)
        y = z.astype(object) * self.n - np.array(off, object)
        flat = np.array([float(v) / self.n if abs(v) < 1 << 1000 else float(v // self.n) for v in y.ravel()]).reshape(y.shape)
        return flat, [int(sum(v * v for v in r)) for r in y]

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        return centred @ self.vectors / np.sqrt(self.values)


def _sum_rows(fit_list: DataFrame, fn, cols: str) -> list:
    """Exact sums over the fit list: ``fn`` yields ``(i, j, value)`` of a block as text integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, list] = {}
        for b in batches:
            dims = np.asarray(b.column(0))
            for d in np.unique(dims).tolist():
                x = _unpack(b.column(1).filter(pa.array(dims == d)), d)
                for kind, m in fn(d, x):
                    key = (d, kind)
                    total[key] = m if key not in total else total[key] + m
        for (d, kind), m in total.items():
            flat = np.asarray(m).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * len(flat), pa.int32()), pa.array([kind] * len(flat), pa.int32()), pa.array(np.arange(len(flat)), pa.int64()), pa.array([str(v) for v in flat])],
                ["d", "kind", "i", "v"],
            )

    part = fit_list.select("d", "x").mapInArrow(run, "d int, kind int, i long, v string")
    return part.groupBy("d", "kind", "i").agg(F.sum(F.col("v").cast(cols)).alias("v")).collect()


def _table(rows: list, d: int, kind: int, shape: tuple, whole: bool) -> np.ndarray:
    out = np.zeros(int(np.prod(shape)), object if whole else float)
    for r in rows:
        if r.d == d and r.kind == kind:
            out[r.i] = int(r.v) if whole else r.v
    return out.reshape(shape)


def _products(y: np.ndarray) -> np.ndarray:
    """``y^T y`` in exact integers: double products while every sum stays below 2**53."""
    out = np.zeros((y.shape[1],) * 2, object)
    most = float(np.abs(y).max(initial=0)) + 1
    step = int(_EXACT / (most * most))
    if step < 1:
        y = y.astype(object)
        return y.T @ y
    for at in range(0, len(y), min(step, 1 << 16)):
        z = y[at : at + min(step, 1 << 16)].astype(float)
        out = out + (z.T @ z).astype(np.int64).astype(object)
    return out


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> dict[int, Fit]:
    """The fit of every vector length in the table (normally one). See ``whiten``."""
    src = vectors.select(F.col(vector_col).cast("array<double>").alias("vec")).where(_valid("vec")).where("size(vec) > 0")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, _, x in _groups(b.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array([d] * len(x), pa.int32()), pa.array([_pack(r) for r in x], pa.binary())], ["d", "x"])

    distinct = write_table(src.mapInArrow(pack, "d int, x binary").distinct(), "whitening-fit")
    sums = _sum_rows(distinct, lambda d, x: [(0, np.array([len(x)], object)), (1, _column_sums(x))], "decimal(38,0)")
    dims = sorted({r.d for r in sums})
    n = {d: int(_table(sums, d, 0, (1,), True)[0]) for d in dims}
    s = {d: [int(v) for v in _table(sums, d, 1, (d,), True)] for d in dims}
    mid = {d: [_mean(v, n[d]) for v in s[d]] for d in dims}

    def second(d: int, x: np.ndarray) -> list:
        return [(0, _products(x - np.array(mid[d], np.int64)))]

    squares = _sum_rows(distinct, second, "decimal(38,0)")
    out = {}
    for d in dims:
        off = np.array([v - n[d] * m for v, m in zip(s[d], mid[d])], object)
        exact = _table(squares, d, 0, (d, d), True) * n[d] - np.outer(off, off)  # n^2 times the covariance
        cov = np.array([[int(v) / (n[d] * n[d]) for v in r] for r in exact])
        values, vecs = leading_eigenpairs(cov, components)
        out[d] = Fit(n[d], s[d], values, vecs, float(sum(int(exact[i, i]) for i in range(d)) / (n[d] * n[d])))

    def third(d: int, x: np.ndarray) -> list:
        z = out[d].whiten(out[d].centred(x)[0])
        return [(0, z.sum(0)), (1, z.T @ z)]

    got = _sum_rows(distinct, third, "double")
    for d in dims:
        k = len(out[d].values)
        mean = _table(got, d, 0, (k,), False) / n[d]
        cov = _table(got, d, 1, (k, k), False) / n[d] - np.outer(mean, mean)
        err = float(np.abs(cov - np.eye(k)).max(initial=0))
        out[d] = Fit(n[d], s[d], out[d].values, out[d].vectors, out[d].trace, err)
    drop_table(distinct)
    return out


def whiten(rows: DataFrame, fits: dict[int, Fit], id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, component, n, deviation, deviation_wide, whitened, eigenvalue, explained,
    identity_error)``: one row for each row of ``rows`` and component.

    NULL vectors and vectors with NULL, NaN, infinite or enormous (beyond 2**46 / 64)
    entries are dropped; a NULL id stays NULL; repeated rows are repeated in the result
    but count once in the fit. Only the two named columns are read, so others may have any name. Vectors of
    another length are a space of their own, with their own fit. There are as many
    components as positive eigenvalues, at most ``components``: a table whose distinct
    vectors number one, empty vectors and an empty table give no rows. ``deviation`` is
    NULL if it does not fit a long; ``deviation_wide`` holds it as text in any case.
    """
    src = rows.select(F.col(id_col), F.col(vector_col).cast("array<double>").alias("vec"))
    ident = src.schema.fields[0]
    fields = [
        T.StructField(id_col, ident.dataType), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()), T.StructField("deviation_wide", T.StringType()), T.StructField("whitened", T.DoubleType()),
        T.StructField("eigenvalue", T.DoubleType()), T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, at, x in _groups(b.column(1)):
                f = fits.get(d)
                k = len(f.values) if f else 0
                if not k:
                    continue
                c, dev = f.centred(x)
                m = len(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(pa.array(np.repeat(at, k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array([f.n] * (m * k), pa.int64()),
                        pa.array([v if v < 1 << 63 else None for v in dev], pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array([str(v) for v in dev]).take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array(f.whiten(c).ravel()),
                        pa.array(np.tile(f.values, m)),
                        pa.array(np.tile(f.values / f.trace, m)),
                        pa.array([f.identity_error] * (m * k), pa.float64()),
                    ],
                    [f.name for f in fields],
                )

    return src.where(_valid("vec")).mapInArrow(run, T.StructType(fields))

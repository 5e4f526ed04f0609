"""Helpers shared by the operators of this subpackage: shared-folder tables,
Arrow batches, connected components and a bounded membership filter."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import ensure_checkpoint_dir, ship_by_value

ship_by_value(__name__)


# ---------------------------------------------------------------- tables in the shared folder
def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back: cuts the
    lineage, survives lost executors, and later uses do not compute it again."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tl_path = path
    return out


def drop_table(df: DataFrame) -> None:
    """Delete a table made by ``write_table`` once nothing reads it any more."""
    path = getattr(df, "_tl_path", None)
    if path:
        spark = df.sparkSession
        hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hp, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- Arrow batches
def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, shared by its tasks."""
    mod = sys.modules.setdefault("_turnloom_worker_cache", types.ModuleType("_turnloom_worker_cache"))
    return mod.__dict__.setdefault(name, {})


def give_back() -> None:
    """What this worker has freed goes back to the machine. Idle workers of an executor stay
    beside those at work, and would keep the most they ever held."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # another C library
        pass


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, with ``give_back`` at the end of each task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def by_bytes(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``limit`` bytes of text; a longer text stands alone."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(size):
        done = size[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(size, done + limit, "right")))
        yield a, b
        a = b


def append_columns(df: DataFrame, inputs: list[str], fields: list[T.StructField], fn: Callable[..., list[pa.Array]], at_once: int | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` plus ``fields``, which ``fn(*input arrays)`` computes for each Arrow batch, or
    for runs of its rows of about ``at_once`` bytes. Columns of ``df`` that have the name of
    an output field are replaced, those of ``drop`` do not come back from the worker."""
    new = [f.name for f in fields]
    base = [f for f in df.schema.fields if f.name not in new and f.name not in drop]
    keep = [i for i, f in enumerate(df.schema.fields) if f in base]
    at = [df.columns.index(c) for c in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = max(1, b.num_rows * at_once // max(b.nbytes, 1) if at_once else b.num_rows)
            for i in range(0, b.num_rows, n):
                some = b.slice(i, n)
                out = [some.column(i) for i in keep] + fn(*[some.column(i) for i in at])
                yield pa.RecordBatch.from_arrays(out, [f.name for f in base] + new)

    return df.mapInArrow(lean(run), T.StructType(base + fields))


def byte_views(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every row; NULL is empty."""
    return [v if v is not None else b"" for v in col.cast(pa.binary() if not pa.types.is_large_string(col.type) else pa.large_binary()).to_pylist()]


# ---------------------------------------------------------------- hashing of byte positions
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INV = np.uint64(pow(int(BASE), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base**2, ... (mod 2**64), kept by the worker and grown when needed."""
    cache = worker_cache("powers")
    have = cache.get(int(base))
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        step = np.full(size, base, np.uint64)
        step[0] = 1
        cache[int(base)] = have = np.multiply.accumulate(step)
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finaliser (spreads the low-entropy polynomial values)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[j] = sum of (data[i] + 1) * BASE**i for i < j."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] that does not depend on where it stands."""
    return mix64((prefix[end] - prefix[start]) * powers(BASE_INV, len(prefix))[start])


# ---------------------------------------------------------------- bounded membership filter
def membership_bits(hashes: DataFrame, col: str, bits_log2: int) -> np.ndarray:
    """A bitmap of 2**bits_log2 bits with the hashes' low bits set. Its size is fixed by
    the parameter, whatever the input; it only lets through, never decides."""
    words = hashes.select(
        F.expr(f"shiftrightunsigned({col}, 6) & {(1 << (bits_log2 - 6)) - 1}L").alias("w"),
        F.expr(f"shiftleft(1L, CAST({col} & 63 AS INT))").alias("b"),
    )
    got = words.groupBy("w").agg(F.expr("bit_or(b)").alias("b")).toArrow()
    out = np.zeros(1 << (bits_log2 - 6), np.uint64)
    if got.num_rows:
        out[got["w"].to_numpy()] = got["b"].to_numpy().view(np.uint64)
    return out


def maybe_member(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    h = hashes.view(np.uint64)
    w = (h >> np.uint64(6)) & np.uint64(len(bitmap) - 1)
    return ((bitmap[w] >> (h & np.uint64(63))) & np.uint64(1)).astype(bool)


# ---------------------------------------------------------------- connected components
def local_labels(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of 0..n-1 along the links (u, v); vectorised
    hooking and pointer jumping."""
    label = np.arange(n)
    while len(u):
        a, b = label[u], label[v]
        live = a != b
        u, v, a, b = u[live], v[live], a[live], b[live]
        if not len(u):
            break
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def connected_components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """``(node, component)`` for the nodes of ``edges (u, v)``, component = smallest node.

    Alternating large-star and small-star steps; each step is joins and grouped minima
    (partial aggregation before the shuffle; a hub is a skewed join key against one row,
    which AQE splits). Every round is a table in the shared folder. Self-links and
    repeated links are allowed; no edges give no rows.
    """
    cur = write_table(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    state = _edge_state(cur)
    while state[0]:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        star = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        star = write_table(star, name)
        low = star.groupBy("u").agg(F.min("v").alias("m"))
        nxt = (
            star.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        nxt = write_table(nxt, name)
        drop_table(star)
        drop_table(cur)
        cur, before, state = nxt, state, _edge_state(nxt)
        if state == before:
            break
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _edge_state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return (r["n"], r["h"])


# ---------------------------------------------------------------- winnowing
def sliding_first_min(values: np.ndarray, window: int) -> np.ndarray:
    """For every window of ``window`` values, the place of its smallest one (leftmost of
    equals), in linear time: prefix and suffix minima of blocks as long as the window.

    Compared are the values' upper 40 bits, then the place (values of one call number
    fewer than 2**24), so the choice depends on the window's content alone.
    """
    n = len(values) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    if len(values) >= 1 << 24:
        raise ValueError("cut the input in pieces first")
    key = (values & ~np.uint64(0xFFFFFF)) | np.arange(len(values), dtype=np.uint64)
    full = -(-len(key) // window) * window
    block = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    block[: len(key)] = key
    block = block.reshape(-1, window)
    up = np.minimum.accumulate(block, axis=1).ravel()
    down = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(down[:n], up[window - 1 : window - 1 + n]) & np.uint64(0xFFFFFF)).astype(np.int64)

"""Benchmark decontamination by winnowing.

A benchmark item is leaked where ``span`` consecutive item words stand in a document
(an item of fewer words: all of them). Both sides keep the smallest of every ``window``
neighbouring k-gram hashes, with ``k + window - 1 = span``, so any shared run of
``span`` words leaves a common fingerprint on both sides. Fingerprints are joined on
their hash, and each hit is extended word by word over the neighbouring words that
travel with it; runs that reach ``span`` words are the leaked words. Hashes only
nominate: words are compared as text. For items shorter than ``span`` the k-gram is the
item and the window is 1.

At scale: one narrow pass over the documents; only fingerprints that pass a bitmap of
the benchmark's hashes (size fixed by ``filter_bits``) leave it, each with its
neighbourhood. The benchmark is reduced to distinct word sequences first, so copies of
an item are one entry; item lists are built once per distinct set of entries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import ship_by_value
from .common import by_bytes, lean, maybe_member, membership_bits, mix64, prefix_hash, sliding_first_min, span_hash, write_table

ship_by_value(__name__)

SPAN = 10
K = 8
FILTER_BITS = 24
_PIECE = 1 << 20
_BYTES_AT_ONCE = 4 << 20  # of texts held as bytes
# A-Z to a-z; 0-9, a-z and all bytes from 0x80 are word bytes; the rest separates.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


class Words:
    """The words of one text: their hashes, and their bytes by place."""

    def __init__(self, data: bytes):
        self.data = data.translate(_TABLE)
        arr = np.frombuffer(self.data, np.uint8)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], (arr != 32).view(np.int8), [0]])))
        self.start, self.end = edge[::2], edge[1::2]
        parts, a = [], 0
        while a < len(self.start):  # pieces, so that a long text needs little at once
            z = max(a + 1, int(np.searchsorted(self.end, self.start[a] + _PIECE, "right")))
            lo = self.start[a]
            p = prefix_hash(arr[lo : self.end[z - 1]])
            parts.append(span_hash(p, self.start[a:z] - lo, self.end[a:z] - lo))
            a = z
        self.hash = np.concatenate(parts) if parts else np.zeros(0, np.uint64)

    def __len__(self) -> int:
        return len(self.start)

    def text(self, a: int, z: int) -> bytes:
        return b" ".join([self.data[i:j] for i, j in zip(self.start[a:z].tolist(), self.end[a:z].tolist())])

    def grams(self, k: int) -> np.ndarray:
        """Hash of every k consecutive words."""
        n = len(self) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        out = np.full(n, k, np.uint64)
        for i in range(k):
            out = out * np.uint64(0x9E3779B97F4A7C15) + self.hash[i : i + n]
        return mix64(out)

    def winnowed(self, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the smallest k-gram of every window."""
        h = self.grams(k)
        step, picked = (1 << 23), []
        for a in range(0, max(len(h) - window + 1, 0), step):
            picked.append(a + sliding_first_min(h[a : a + step + window - 1], window))
        at = np.unique(np.concatenate(picked)) if picked else np.zeros(0, np.int64)
        return at, h[at]


_HIT = T.StructType([T.StructField("h", T.LongType()), T.StructField("k", T.IntegerType()), T.StructField("off", T.IntegerType()), T.StructField("ctx", T.BinaryType()), T.StructField("at", T.ArrayType(T.IntegerType()))])
_HIT_ARROW = pa.list_(pa.struct([("h", pa.int64()), ("k", pa.int32()), ("off", pa.int32()), ("ctx", pa.binary()), ("at", pa.list_(pa.int32()))]))


def _neighbourhoods(w: Words, at: np.ndarray, h: np.ndarray, k: int, reach: int) -> list[dict]:
    """Fingerprints with ``reach`` words on both sides; equal ones share a row."""
    rows: dict[tuple, list[int]] = {}
    for p, x in zip(at.tolist(), h.view(np.int64).tolist()):
        lo = max(0, p - reach)
        rows.setdefault((x, k, p - lo, w.text(lo, p + k + reach)), []).append(p)
    return [{"h": x, "k": k_, "off": off, "ctx": ctx, "at": ps} for (x, k_, off, ctx), ps in rows.items()]


def _fingerprints(df: DataFrame, keep, bitmap, short: list[int], span: int, k: int) -> DataFrame:
    """``df (uid..., text)`` to ``keep`` columns, ``n_words`` and the nominated hits.
    ``bitmap`` None: all fingerprints of the text's own kind (the benchmark side)."""
    names = [f.name for f in keep]
    at_col = [df.columns.index(c) for c in names]
    text_at = df.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value if bitmap is not None else None
        for b in (batch.slice(i, j - i) for batch in batches for i, j in by_bytes(batch.column(text_at), _BYTES_AT_ONCE)):
            n_words, hits = [], []
            for data in b.column(text_at).cast(pa.binary()).to_pylist():
                w = Words(data or b"")
                got: list[dict] = []
                if bits is None:
                    if len(w) >= span:
                        got = _neighbourhoods(w, *w.winnowed(k, span - k + 1), k, span - k)
                    elif len(w):
                        got = _neighbourhoods(w, *w.winnowed(len(w), 1), len(w), 0)
                else:
                    for kk, window, reach in [(k, span - k + 1, span - k)] + [(s, 1, 0) for s in short]:
                        at, h = w.winnowed(kk, window)
                        live = maybe_member(bits, h)
                        got += _neighbourhoods(w, at[live], h[live], kk, reach)
                n_words.append(len(w))
                hits.append(got)
            out = [b.column(i) for i in at_col] + [pa.array(n_words, pa.int64()), pa.array(hits, _HIT_ARROW)]
            yield pa.RecordBatch.from_arrays(out, names + ["n_words", "hits"])

    return df.mapInArrow(lean(run), T.StructType([*keep, T.StructField("n_words", T.LongType()), T.StructField("hits", T.ArrayType(_HIT))]))


def _extend(pairs: DataFrame, span: int) -> DataFrame:
    """Fingerprint pairs to leaked runs ``(uid, entry, first, last + 1)`` of document words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            uid, entry, first, end = [], [], [], []
            c = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)}
            for u, e, k, ctx, off, at, ictx, ioff in zip(c["uid"], c["entry"], c["k"], c["ctx"], c["off"], c["at"], c["ictx"], c["ioff"]):
                d, i = ctx.split(b" "), ictx.split(b" ")
                if d[off : off + k] != i[ioff : ioff + k]:
                    continue
                left = 0
                while left < min(off, ioff) and d[off - left - 1] == i[ioff - left - 1]:
                    left += 1
                right = 0
                while off + k + right < len(d) and ioff + k + right < len(i) and d[off + k + right] == i[ioff + k + right]:
                    right += 1
                if left + k + right >= span or k < span and len(i) == k:
                    for p in at:
                        uid.append(u), entry.append(e), first.append(p - left), end.append(p + k + right)
            yield pa.RecordBatch.from_arrays([pa.array(uid, pa.int64()), pa.array(entry, pa.binary()), pa.array(first, pa.int64()), pa.array(end, pa.int64())], ["uid", "entry", "a", "z"])

    return pairs.mapInArrow(lean(run), "uid long, entry binary, a long, z long")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    span: int = SPAN,
    k: int = K,
    filter_bits: int = FILTER_BITS,
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per document: ``id_col``, the ``carry`` columns, ``n_words``, ``n_hit``
    (leaked words), ``n_items``, ``items_sha256``, ``spans`` (runs ``[a, z)`` of leaked
    words, merged) and ``contaminated``.

    NULL or empty texts have no words and are clean; repeated rows and repeated ids keep
    their rows; an item without words matches nothing; an item id that is NULL is not
    listed or counted, but its windows are leaks; copies of an item are all listed; an
    empty benchmark leaves every document clean.
    """
    carry = carry or []
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    keep_item = [T.StructField("item", T.StringType())]
    raw = _fingerprints(items, keep_item, None, [], span, k).where("n_words > 0")
    # an entry is a distinct list of fingerprints with their surroundings: copies of an item are one entry
    raw = raw.withColumn("entry", F.unhex(F.sha2(F.concat_ws("|", F.transform("hits", lambda x: F.concat_ws(",", F.hex(x["ctx"]), F.concat_ws(".", x["at"])))), 256)))
    entries = write_table(raw, "decontaminate-items")
    prints = entries.dropDuplicates(["entry"]).select("entry", "n_words", F.explode("hits").alias("x"))
    prints = write_table(prints.select("entry", "x.h", "x.k", F.col("x.off").alias("ioff"), F.col("x.ctx").alias("ictx")).distinct(), "decontaminate-prints")
    short = sorted(r["k"] for r in prints.where((F.col("k") < span) & (F.length("ictx") > 0)).join(
        entries.where(F.col("n_words") < span).select("entry").distinct(), "entry", "left_semi").select("k").distinct().collect())  # at most span - 1 values
    spark = docs.sparkSession
    bitmap = spark.sparkContext.broadcast(membership_bits(prints, "h", filter_bits))

    keep = [T.StructField("uid", T.LongType()), T.StructField("id", docs.schema[id_col].dataType)] + [T.StructField(f"c_{c}", docs.schema[c].dataType) for c in carry]
    src = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), *[F.col(c).alias(f"c_{c}") for c in carry], F.col(text_col).cast("string").alias("text"))
    base = write_table(_fingerprints(src, keep, bitmap, short, span, k), "decontaminate-docs")

    found = base.where(F.size("hits") > 0).select("uid", F.explode("hits").alias("x")).select("uid", "x.*")
    runs = write_table(_extend(found.join(prints, ["h", "k"]), span), "decontaminate-runs")

    in_order = F.array_sort(F.collect_set(F.struct("a", "z")))
    merged = F.expr(
        "aggregate(spans, CAST(array() AS array<struct<a:bigint,z:bigint>>), (acc, s) -> IF(size(acc) > 0 AND s.a <= element_at(acc, -1).z,"
        " concat(slice(acc, 1, size(acc) - 1), array(named_struct('a', element_at(acc, -1).a, 'z', greatest(element_at(acc, -1).z, s.z)))),"
        " concat(acc, array(s))))"
    )
    spans = runs.select("uid", "a", "z").distinct().groupBy("uid").agg(in_order.alias("spans")).select("uid", merged.alias("spans"))
    sets = runs.groupBy("uid").agg(F.array_sort(F.collect_set("entry")).alias("set")).withColumn("set_id", F.sha2(F.concat_ws(",", F.transform("set", F.hex)), 256))
    by_entry = entries.where("item IS NOT NULL").select("entry", "item").distinct()
    lists = sets.groupBy("set_id").agg(F.first("set").alias("set")).select("set_id", F.explode("set").alias("entry"))
    lists = lists.join(by_entry, "entry").groupBy("set_id").agg(F.array_sort(F.collect_set("item")).alias("items"))
    lists = lists.select("set_id", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"))
    leaked = spans.join(sets.select("uid", "set_id"), "uid").join(lists, "set_id", "left").drop("set_id")
    out = base.drop("hits").join(leaked, "uid", "left")
    n_hit = F.expr("CAST(aggregate(coalesce(spans, array()), 0L, (n, s) -> n + s.z - s.a) AS BIGINT)")
    return out.select(
        F.col("id").alias(id_col),
        *[F.col(f"c_{c}").alias(c) for c in carry],
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        "spans",
        (n_hit > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH d AS (
  SELECT rowid_ AS rid, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws
  FROM (SELECT row_number() OVER () AS rowid_, doc_id, text FROM documents)),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws
  FROM benchmark),
iw AS (
  SELECT DISTINCT item, least(len(ws), 10) AS l, array_to_string(ws[s : s + least(len(ws), 10) - 1], ' ') AS t
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS s FROM i WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT l FROM iw),
dw AS (
  SELECT rid, l, s, array_to_string(ws[s : s + l - 1], ' ') AS t
  FROM (SELECT rid, ws, l, unnest(range(1, len(ws) - l + 2)) AS s FROM d, lens WHERE len(ws) >= l)),
m AS (SELECT dw.rid, dw.l, dw.s, iw.item FROM dw JOIN iw ON dw.l = iw.l AND dw.t = iw.t),
h AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + l)) AS p FROM (SELECT DISTINCT rid, l, s FROM m)) GROUP BY rid),
g AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM m WHERE item IS NOT NULL) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(g.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(g.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON h.rid = d.rid LEFT JOIN g ON g.rid = d.rid
"""

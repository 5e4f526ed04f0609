"""Exact substring dedup with suffix arrays (induced sorting, permuted common prefixes).

Every byte covered by a ``span``-byte string that also starts anywhere else goes.

Sharding. Each span-long window is named by an anchor: its smallest ``K``-byte hash
(leftmost of equals). Equal windows have equal anchors, so a window can only match
windows of its anchor's group, and the windows of one anchor in one text are a run: its
segment. Whole texts that are copies are reduced to one with a count, equal segments to
one with a count; segments whose anchor occurs once are never cut out (a bitmap of fixed
size, ``filter_bits``, sorts most of them out, grouping decides). What is left, groups
with different segments, is cut from the texts and dealt by anchor. A task concatenates
whole groups up to ``PACK_BYTES`` (one group alone may be larger), builds the suffix array by induced sorting and the
permuted common prefixes, and reports the windows that share ``span`` bytes with a
neighbour in the order. Only windows of the segment's own anchor count, so no place is
compared with itself.

Hot anchors. A group above ``SHARD_BYTES`` of different segments is dealt anew: a window
that holds enough bytes left of the anchor is renamed by the anchor and those bytes, any
other by the anchor and bytes to its right. Names grow until they are whole windows, so
every group ends below the limit without losing a match.

Texts cross the network once (by content, into a bucketed table); later joins bring
narrow rows to them.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import ensure_checkpoint_dir, ship_by_value
from .common import by_bytes, lean, maybe_member, membership_bits, mix64, prefix_hash, shuffle_partitions, sliding_first_min, span_hash, write_table
from .suffix_array import permuted_lcp, suffix_array

ship_by_value(__name__)

SPAN = 200
K = 64
FILTER_BITS = 26
SHARD_BYTES = 2 << 20  # of one group at most
PACK_BYTES = 1 << 19  # of small groups in one suffix array
_PIECE = 1 << 20
_BYTES_AT_ONCE = 2 << 20  # of texts, with what is cut from them
_KEY = ["k1", "k2"]


def text_key(text: Column) -> list[Column]:
    """Two longs (120 bits of md5) that name a text; NULL is empty."""
    md5 = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return [F.conv(F.substring(md5, a, 15), 16, 10).cast("long").alias(n) for a, n in ((1, "k1"), (16, "k2"))]


def _distinct_texts(docs: DataFrame, text_col: str) -> DataFrame:
    """``(k1, k2, data, copies)``, stored by key so that later joins leave it in place."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    src = docs.select(*text_key(text), F.coalesce(text, F.lit("")).cast("binary").alias("data"))
    one = src.groupBy(*_KEY).agg(F.first("data").alias("data"), F.count(F.lit(1)).alias("copies"))
    name = f"texts_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/suffix-{name}"
    parts = shuffle_partitions(spark)
    one.repartition(parts, *_KEY).write.bucketBy(parts, *_KEY).option("path", path).saveAsTable(name)
    return spark.table(name)


# ---------------------------------------------------------------- anchors and segments
def anchors(data: np.ndarray, span: int = SPAN, k: int = K) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Segments of one text, piece by piece: piece offset and its prefix hash, then for
    each segment the anchor hash, anchor place, first window and number of windows (all
    relative to the piece). A run cut by a piece's end is two segments of one anchor."""
    for lo in range(0, max(len(data) - span + 1, 0), _PIECE):
        piece = data[lo : lo + _PIECE + span - 1]
        p = prefix_hash(piece)
        at = np.arange(len(piece) - k + 1)
        h = span_hash(p, at, at + k)
        place = sliding_first_min(h, span - k + 1)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        n = np.diff(np.append(first, len(place)))
        yield lo, p, h[place[first]], place[first], first, n


def _anchor_hashes(texts: DataFrame, span: int, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [seg[2] for v in b.column(0) for seg in anchors(np.frombuffer(v.as_buffer(), np.uint8), span, k)]
            if found:
                h, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])

    return texts.select("data").mapInArrow(lean(run), "h long, n long")


_SEGMENT = "k1 long, k2 long, h long, seg long, s0 long, n int, c0 int, c1 int"


def _segments(texts: DataFrame, bitmap, span: int, k: int) -> DataFrame:
    """Narrow rows of the segments whose anchor may occur again: ``h`` names the group,
    ``seg`` the content, ``s0`` the first window, ``n`` the windows, ``[c0, c1)`` the bytes
    that all members of the group share, relative to ``s0``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for b in batches:
            rows: list[list[np.ndarray]] = []
            for k1, k2, v in zip(b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2)):
                for lo, p, h, place, first, n in anchors(np.frombuffer(v.as_buffer(), np.uint8), span, k):
                    live = maybe_member(bits, h)
                    if live.any():
                        h, place, first, n = h[live], place[live], first[live], n[live]
                        seg = span_hash(p, first, first + n + span - 1)
                        m = len(h)
                        rows.append([np.full(m, k1), np.full(m, k2), h.view(np.int64), seg.view(np.int64), first + lo, n.astype(np.int32), (place - first).astype(np.int32), (place - first + k).astype(np.int32)])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows)], _names(_SEGMENT))

    return texts.select(*_KEY, "data").mapInArrow(lean(run), _SEGMENT)


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _with_text(rows: DataFrame, texts: DataFrame, cols: list[str]) -> DataFrame:
    """Each text once, with all its rows (as many as its own segments at most)."""
    return rows.groupBy(*_KEY).agg(F.collect_list(F.struct(*cols)).alias("rows")).join(texts.select(*_KEY, "data"), _KEY)


def _refine(hot: DataFrame, texts: DataFrame, span: int) -> DataFrame:
    """Segments of hot groups under longer names; see the module text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for k1, k2, found, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
                arr = np.frombuffer(data.as_buffer(), np.uint8)
                for r in found:
                    half = -(-(span - (r["c1"] - r["c0"])) // 2)
                    cut = min(max(r["c0"] - half + 1, 0), r["n"])  # windows before it have ``half`` bytes left of the core
                    right = span - (r["c1"] - r["c0"]) - half + 1
                    for a, z, c0, c1 in ((0, cut, r["c0"] - half, r["c1"]), (cut, r["n"], r["c0"], r["c1"] + right)):
                        if a < z:
                            s0 = r["s0"] + a
                            part = arr[s0 : s0 + z - a + span - 1]
                            p = prefix_hash(part)
                            core = span_hash(p, np.array([c0 - a]), np.array([c1 - a]))
                            h = mix64(core + np.uint64(r["h"] % (1 << 64)) * np.uint64(2 * (c0 < r["c0"]) + 3))
                            seg = span_hash(p, np.array([0]), np.array([len(part)]))
                            rows.append((k1, k2, int(h.view(np.int64)[0]), int(seg.view(np.int64)[0]), s0, z - a, c0 - a, c1 - a))
            if rows:
                kinds = [pa.int64()] * 5 + [pa.int32()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], _names(_SEGMENT))

    return _with_text(hot, texts, ["h", "s0", "n", "c0", "c1"]).mapInArrow(lean(run), _SEGMENT)


# ---------------------------------------------------------------- one shard
def repeated_windows(parts: list[bytes], n: list[int], span: int = SPAN) -> list[np.ndarray]:
    """For each segment, which of its first ``n`` windows also start elsewhere in the shard."""
    size = np.array([len(p) for p in parts])
    end = np.cumsum(size + 1) - 1
    begin = end - size
    data = np.frombuffer(b"\0".join(parts) + b"\0\0", np.uint8)
    t = data.astype(np.int16) + 2
    t[end] = 1
    t[-1] = 0
    left = np.zeros(len(t), np.int64)
    left[:-1] = np.repeat(end, size + 1) - np.arange(len(t) - 1)
    sa = suffix_array(t, 258)
    shared = permuted_lcp(data, sa, left)[sa]
    group = np.cumsum(shared < span)
    own = np.zeros(len(t), bool)
    for a, m in zip(begin.tolist(), n):
        own[a : a + m] = True
    member = own[sa]
    count = np.bincount(group[member], minlength=group[-1] + 1)
    flag = np.zeros(len(t), bool)
    flag[sa] = member & (count[group] > 1)
    return [flag[a : a + m] for a, m in zip(begin.tolist(), n)]


def _runs(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flag.view(np.int8), [0]])))
    return edge[::2], edge[1::2]


def _search(cut: DataFrame, span: int, pack_bytes: int) -> DataFrame:
    """Segments ``(h, seg, n, c0, part)``, whole groups in order of ``h``, to runs of repeated windows.
    A suffix array takes some fifty times its bytes, so small ones are built one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, key, since = 0, None, 0

        def out(rows: list[tuple]) -> pa.RecordBatch:
            cols: list[list] = [[], [], [], [], [], []]
            for r, flag in zip(rows, repeated_windows([r[4] for r in rows], [r[2] for r in rows], span)):
                for a, z in zip(*(x.tolist() for x in _runs(flag))):
                    for c, v in zip(cols, (*r[:4], a, z)):
                        c.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["h", "seg", "n", "c0", "a", "z"])

        for b in batches:
            for r in zip(*[b.column(i).to_pylist() for i in range(5)]):
                if r[0] != key:
                    if size >= pack_bytes:
                        yield out(held)
                        held, size = [], 0
                    key = r[0]
                held.append(r)
                size += len(r[4])
        if held:
            yield out(held)

    return cut.mapInArrow(lean(run), "h long, seg long, n int, c0 int, a int, z int")


def repeated_spans(texts: DataFrame, span: int = SPAN, k: int = K, filter_bits: int = FILTER_BITS, shard_bytes: int | None = None) -> DataFrame:
    """``(k1, k2, a, z)``: runs of windows ``a <= start < z`` of distinct texts that also start elsewhere."""
    limit = shard_bytes or SHARD_BYTES
    again = _anchor_hashes(texts, span, k).groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")
    bitmap = texts.sparkSession.sparkContext.broadcast(membership_bits(again, "h", filter_bits))
    rows = write_table(_segments(texts, bitmap, span, k), "suffix-segments")
    name = ["h", "seg", "n", "c0"]
    spans = None
    while True:
        one = rows.groupBy(*name).agg(F.count(F.lit(1)).alias("m"), F.min(F.struct(*_KEY, "s0")).alias("at"))
        one = write_table(one, "suffix-distinct")
        groups = one.groupBy("h").agg(F.count(F.lit(1)).alias("segs"), F.sum(F.col("n") + span - 1).alias("bytes")).where("segs > 1")
        groups = write_table(groups, "suffix-groups")
        hot = groups.where(F.col("bytes") > limit).select("h")
        cold = groups.where(F.col("bytes") <= limit).select("h")
        cut = _cut(one.join(cold, "h"), texts, span)
        found = _search(cut.repartition("h").sortWithinPartitions("h", "seg"), span, min(limit, PACK_BYTES))
        whole = one.where("m > 1").select(*name, F.lit(0).alias("a"), F.col("n").alias("z"))
        found = found.join(whole.select(*name), name, "left_anti").unionByName(whole)
        got = rows.select(*_KEY, "s0", *name).join(found, name).select(*_KEY, (F.col("s0") + F.col("a")).alias("a"), (F.col("s0") + F.col("z")).alias("z"))
        got = write_table(got, "suffix-spans")
        spans = got if spans is None else spans.unionByName(got)
        if hot.isEmpty():
            return spans
        rows = write_table(_refine(rows.join(hot, "h", "left_semi").where(F.col("c1") - F.col("c0") < span), texts, span), "suffix-segments")


def _cut(one: DataFrame, texts: DataFrame, span: int) -> DataFrame:
    """The bytes of one occurrence of each distinct segment."""
    need = one.select("at.k1", "at.k2", "h", "seg", "n", "c0", F.col("at.s0").alias("s0"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in by_bytes(b.column(3), _BYTES_AT_ONCE):
                some = b.slice(i, j - i)
                cols: list[list] = [[], [], [], [], []]
                for found, data in zip(some.column(2).to_pylist(), some.column(3)):
                    raw = data.as_buffer()
                    for r in found:
                        for c, v in zip(cols, (r["h"], r["seg"], r["n"], r["c0"], raw.slice(r["s0"], r["n"] + span - 1).to_pybytes())):
                            c.append(v)
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["h", "seg", "n", "c0", "part"])

    return _with_text(need, texts, ["h", "seg", "n", "c0", "s0"]).mapInArrow(lean(run), "h long, seg long, n int, c0 int, part binary")


def kept_texts(docs: DataFrame, text_col: str = "text", span: int = SPAN, with_text: bool = False, **limits) -> DataFrame:
    """Per distinct text: ``k1, k2, n_bytes, n_removed, n_spans, kept_sha256`` and, if
    asked for, ``kept`` (the text of the remaining bytes, without characters that lost some)."""
    texts = _distinct_texts(docs, text_col)
    spans = repeated_spans(texts, span, **limits).groupBy(*_KEY).agg(F.collect_list(F.struct("a", "z")).alias("rows"))
    joined = texts.join(spans, _KEY, "left").select(*_KEY, "data", "copies", "rows")
    schema = "k1 long, k2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept string" if with_text else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in by_bytes(b.column(2), _BYTES_AT_ONCE):
                some, out = b.slice(i, j - i), []
                for data, copies, rows in zip(some.column(2), some.column(3).to_pylist(), some.column(4).to_pylist()):
                    raw = data.as_buffer().to_pybytes()
                    if copies > 1 and len(raw) >= span:  # every window also starts in the copy
                        rows = [{"a": 0, "z": len(raw) - span + 1}]
                    removed, runs, kept = 0, 0, raw
                    if rows:
                        edge = np.zeros(len(raw) + 1, np.int32)
                        np.add.at(edge, [r["a"] for r in rows], 1)
                        np.add.at(edge, [r["z"] + span - 1 for r in rows], -1)
                        gone = np.cumsum(edge[:-1]) > 0
                        removed, runs, kept = int(gone.sum()), len(_runs(gone)[0]), np.frombuffer(raw, np.uint8)[~gone].tobytes()
                    out.append((len(raw), removed, runs, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore") if with_text else ""))
                kinds = [pa.int64()] * 3 + [pa.string()] * 2
                cols = [pa.array(c, t) for c, t in zip(zip(*out), kinds)][: 5 if with_text else 4]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), *cols], _names(schema))

    return joined.mapInArrow(lean(run), schema)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, **limits) -> DataFrame:
    """One row per document: ``id_col``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal
    removed runs) and ``kept_sha256`` of the remaining bytes.

    NULL text is empty; texts shorter than ``span`` lose nothing; repeated rows are
    copies of each other and lose everything a span covers; repeated or NULL ids keep
    their rows; no rows give no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("__id"), *text_key(F.col(text_col).cast("string")))
    got = rows.join(kept_texts(docs, text_col, span, **limits), _KEY)
    return got.select(F.col("__id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def cleaned(docs: DataFrame, text_col: str = "text", span: int = SPAN, **limits) -> DataFrame:
    """``docs`` with the repeated bytes cut out of the text. A character that lost some
    of its bytes goes as a whole. NULL texts stay NULL."""
    kept = kept_texts(docs, text_col, span, with_text=True, **limits)
    # the distinct texts meet the documents' other columns: no text crosses twice
    text = kept.select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("kept").alias("__kept"))
    k1, k2 = text_key(F.col(text_col).cast("string"))
    src = docs.select("*", k1.alias("__k1"), k2.alias("__k2"), F.col(text_col).isNotNull().alias("__any")).drop(text_col)
    both = src.join(text, ["__k1", "__k2"])
    return both.select(*[F.when(F.col("__any"), F.col("__kept")).alias(c) if c == text_col else F.col(c) for c in docs.columns])

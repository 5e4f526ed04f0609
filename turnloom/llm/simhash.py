"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints: one narrow pass over the texts (XXH64 of every 3-word shingle, one
vote per bit). Linking works on distinct fingerprints only, so exact copies and
empty texts cost one row however many they are.

Search for pairs at ``max_bits`` or fewer differing bits:

* the 64 bits are cut in ``max_bits + 1`` parts; two close fingerprints agree on at
  least one part, so each fingerprint is dealt to one group per part, named by
  ``(mask, fingerprint & mask)``: a shared masked bit pattern;
* a group above ``GROUP_LIMIT`` distinct fingerprints is dealt anew with the same
  rule on its free bits (mask widened by one part of them), as often as needed.
  With 12 free bits left a group cannot exceed the limit, so it ends, and no pair
  is lost: close codes agree on one part of the free bits too;
* within a group, codes are in Gray rank order, where neighbours share most bits.
  Runs of 16 become nodes that hold the bits all members share, runs of 16 nodes
  become upper nodes, and so on. A search starts at the top with the differences
  in the shared bits, adds at each lower node the differences in the bits that are
  new there, and drops the whole run once the sum passes ``max_bits``.

Only spanning links leave a group (each code to the smallest of its local
component), so the output is linear in the codes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import ship_by_value
from .common import append_columns, byte_views, connected_components, lean, local_labels, write_table

ship_by_value(__name__)

FANOUT = 16
GROUP_LIMIT = 4096
_SHINGLES_AT_ONCE = 1 << 16
_BYTES_AT_ONCE = 4 << 20  # of texts held as strings


def fingerprint_bytes(data: bytes, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of one UTF-8 text; 0 if it has no words. A-Z are lower-cased, words are
    runs of bytes other than space and \\t..\\r; fewer words than ``shingle`` make one
    shingle. A bit is set if over half of the shingle hashes have it."""
    words = data.lower().split()
    if not words:
        return 0
    text = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = end - size
    n = max(1, len(words) - shingle + 1)
    start, end = start[:n], end[min(shingle, len(words)) - 1 :]
    hash_, votes = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, _SHINGLES_AT_ONCE):
        a, b = start[at : at + _SHINGLES_AT_ONCE].tolist(), end[at : at + _SHINGLES_AT_ONCE].tolist()
        h = np.fromiter([hash_(text[i:j], seed) for i, j in zip(a, b)], np.uint64, len(a))
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(0, dtype=np.int64)
    on = np.packbits(votes * 2 > n, bitorder="little")
    return int(on.view("<u8")[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", out: str = "fp", shingle: int = 3, seed: int = 42, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` without ``drop`` plus the fingerprint as a long (same 64 bits). NULL text: 0."""

    def run(text: pa.Array) -> list[pa.Array]:
        got = np.fromiter((fingerprint_bytes(x, shingle, seed) for x in byte_views(text)), np.uint64, len(text))
        return [pa.array(got.view(np.int64))]

    return append_columns(docs, [text_col], [T.StructField(out, T.LongType())], run, _BYTES_AT_ONCE, drop)


# ---------------------------------------------------------------- groups by shared masked bits
def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def widen_mask(mask: int, parts: int) -> list[int]:
    """``mask`` plus one of ``parts`` runs of its free bits, for each run."""
    free = [i for i in range(64) if not mask >> i & 1]
    cuts = [round(i * len(free) / parts) for i in range(parts + 1)]
    return [mask | sum(1 << b for b in free[a:b]) for a, b in zip(cuts, cuts[1:])]


def _deal(rows: DataFrame, masks: list[int], parts: int) -> tuple[DataFrame, list[int]]:
    """Each row's mask widened in ``parts`` ways."""
    table = {m: widen_mask(m, parts) for m in masks}
    pairs = ", ".join(f"{_signed(m)}L, array({', '.join(f'{_signed(x)}L' for x in xs)})" for m, xs in table.items())
    pairs = pairs.replace("-9223372036854775808L", "(-9223372036854775807L - 1L)")
    out = rows.select("fp", F.explode(F.expr(f"element_at(map({pairs}), mask)")).alias("mask"))
    return out.withColumn("pat", F.col("fp").bitwiseAND(F.col("mask"))), sorted({x for xs in table.values() for x in xs})


def gray_rank(fp: Column | str) -> Column:
    """Place of a code in reflected Gray order (as a signed long)."""
    x = F.col(fp) if isinstance(fp, str) else fp
    for s in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, s))
    return x


# ---------------------------------------------------------------- the index of one group
class GrayIndex:
    """Codes in Gray order under nodes of shared bits; see the module text."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        same_and, same_or = [codes], [codes]
        while len(same_and[-1]) > FANOUT:
            cut = np.arange(0, len(same_and[-1]), FANOUT)
            same_and.append(np.bitwise_and.reduceat(same_and[-1], cut))
            same_or.append(np.bitwise_or.reduceat(same_or[-1], cut))
        shared = [~(a ^ o) for a, o in zip(same_and, same_or)]
        self.pattern = same_and
        self.own = []  # bits that a node adds to those of its parent
        for k, s in enumerate(shared):
            up = np.repeat(shared[k + 1], FANOUT)[: len(s)] if k + 1 < len(shared) else np.zeros(len(s), np.uint64)
            self.own.append(s & ~up)

    def close_pairs(self, max_bits: int, at_once: int = 512) -> tuple[np.ndarray, np.ndarray]:
        """Index pairs i < j whose codes differ in ``max_bits`` or fewer bits."""
        out_i, out_j = [], []
        for q0 in range(0, len(self.codes), at_once):
            top = len(self.pattern) - 1
            q = np.arange(q0, min(q0 + at_once, len(self.codes)))
            node = np.tile(np.arange(len(self.pattern[top])), len(q))
            q = np.repeat(q, len(self.pattern[top]))
            acc = np.zeros(len(q), np.int64)
            for k in range(top, -1, -1):
                acc = acc + np.bitwise_count((self.codes[q] ^ self.pattern[k][node]) & self.own[k][node])
                live = (acc <= max_bits) & ((node + 1) * FANOUT**k > q)
                q, node, acc = q[live], node[live], acc[live]
                if k:
                    child = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                    q, acc = np.repeat(q, FANOUT), np.repeat(acc, FANOUT)
                    there = child < len(self.pattern[k - 1])
                    q, node, acc = q[there], child[there], acc[there]
            later = node > q
            out_i.append(q[later])
            out_j.append(node[later])
        return np.concatenate(out_i), np.concatenate(out_j)


def _links_of(codes: np.ndarray, starts: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links within each group; groups are runs of ``codes`` that begin at ``starts``."""
    size = np.diff(np.append(starts, len(codes)))
    group = np.repeat(np.arange(len(starts)), size)
    us, vs = [], []
    small = size <= FANOUT  # one leaf: its members are compared directly
    for d in range(1, min(FANOUT, len(codes))):
        i = np.flatnonzero((group[d:] == group[:-d]) & small[group[d:]])
        i = i[np.bitwise_count(codes[i] ^ codes[i + d]) <= max_bits]
        us.append(i)
        vs.append(i + d)
    for g in np.flatnonzero(~small):
        i, j = GrayIndex(codes[starts[g] : starts[g] + size[g]]).close_pairs(max_bits)
        us.append(i + starts[g])
        vs.append(j + starts[g])
    if not us:
        return codes[:0], codes[:0]
    label = local_labels(len(codes), np.concatenate(us), np.concatenate(vs))
    child = np.flatnonzero(label != np.arange(len(codes)))
    return codes[child], codes[label[child]]


def close_links(fps: DataFrame, max_bits: int = 2, group_limit: int | None = None) -> DataFrame:
    """Links ``(u, v)`` that span every set of distinct fingerprints ``fps (fp)`` connected
    by pairs at ``max_bits`` or fewer differing bits."""
    limit, parts = group_limit or GROUP_LIMIT, max_bits + 1
    rows, masks = _deal(fps.select("fp", F.lit(0).cast("long").alias("mask")), [0], parts)
    ready = []
    while True:
        # free bits of the widest groups; below the limit by counting alone
        if 1 << min(64 - bin(m).count("1") for m in masks) <= limit:
            hot = None
        else:
            hot = rows.groupBy("mask", "pat").count().where(F.col("count") > limit).select("mask", "pat")
            hot = write_table(hot, "simhash-hot")
        if hot is None or hot.isEmpty():
            ready.append(rows)
            break
        ready.append(rows.join(hot, ["mask", "pat"], "left_anti"))
        rows, masks = _deal(rows.join(hot, ["mask", "pat"], "left_semi"), masks, parts)
        rows = rows.distinct()  # two masks can widen to the same one
    dealt = ready[0]
    for r in ready[1:]:
        dealt = dealt.unionByName(r)
    dealt = dealt.select("mask", "pat", "fp").repartition("mask", "pat")
    dealt = dealt.withColumn("g", gray_rank("fp")).sortWithinPartitions("mask", "pat", "g").select("mask", "pat", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64)] * 3

        def links(cols: list[np.ndarray], starts: np.ndarray) -> pa.RecordBatch:
            u, v = _links_of(cols[2].view(np.uint64), starts, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        for b in batches:
            cols = [np.concatenate([r, b.column(i).to_numpy()]) for i, r in enumerate(rest)]
            if not len(cols[0]):
                continue
            new = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0)) + 1
            starts = np.append(0, new)
            cut = starts[-1]  # the last group may go on in the next batch
            rest = [c[cut:] for c in cols]
            if cut:
                yield links([c[:cut] for c in cols], starts[:-1])
        if len(rest[0]):
            yield links(rest, np.zeros(1, np.int64))

    return dealt.mapInArrow(lean(run), "u long, v long")


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2, seed: int = 42, extra: dict[str, Column] | None = None
) -> DataFrame:
    """One row per document: ``id_col``, ``fp`` (long), ``component`` (smallest fingerprint
    reachable by links), ``component_id`` (smallest id reachable, NULL ids apart) and
    the ``extra`` columns.

    NULL or empty texts have fingerprint 0 and link like any other; repeated rows and
    repeated ids each keep their row; NULL ids are allowed (their component takes the
    smallest id that is not NULL, or NULL); no rows give no rows; other columns are
    not read.
    """
    extra = extra or {}
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *[c.alias(f"x_{n}") for n, c in extra.items()])
    rows = write_table(with_fingerprint(src, "text", "fp", shingle, seed, drop=("text",)), "simhash-rows")
    codes = write_table(rows.groupBy("fp").agg(F.min("id").alias("low")), "simhash-codes")
    comp = connected_components(close_links(codes.select("fp"), max_bits), "simhash-cc")
    named = codes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    lows = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(lows, "component").select("fp", "component", "component_id")
    out = rows.join(named, "fp")
    return out.select(F.col("id").alias(id_col), "fp", "component", "component_id", *[F.col(f"x_{n}").alias(n) for n in extra])


def hex16(fp: Column | str) -> Column:
    """16 lower-case hex digits of a long."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each group of near copies: the smallest id that is not
    NULL (ties: the smallest text hash; of repeated rows, one). All columns are kept."""
    h = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    got = write_table(simhash_components(docs, id_col, text_col, shingle, max_bits, extra={"__h": h}), "simhash-groups")
    key = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"), F.col("__h").alias("h"))
    keepers = got.groupBy("component").agg(F.min(key).alias("k")).select(F.col("k.i").alias("__i"), F.col("k.h").alias("__k"))
    src = docs.withColumn("__h", h)
    kept = src.join(keepers, F.col(id_col).eqNullSafe(F.col("__i")) & (F.col("__h") == F.col("__k")), "left_semi")
    repeated = got.groupBy(id_col, "__h").count().where("count > 1")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates([id_col, "__h"])
    return kept.drop("__h")

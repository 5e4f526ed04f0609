"""Skew-safe form of the conversational sample pipeline.

The default plan keeps a conversation in one row (one exchange on ``conv_id``),
which is the fastest plan while conversations are of human size. If one
conversation id holds a large share of all turns (e.g. a defaulted id), that row
and that task would carry it alone. This plan never gathers a conversation:

* run ids: gaps-and-islands per (conv, turn block); each block's first/last role
  and head count are carried across blocks by a window over the block summaries
  (a few rows per block), joined back on (conv, block);
* merged turns: ``groupBy(conv, rid)`` (one group per run);
* block pairs: joins on (conv, rid) and (conv, rid + 1);
* pair windows: each merged turn's digest is copied to the <= P windows that contain it
  and grouped by (conv, window end): groups are bounded by the window size;
* prefixes: one narrow row per model turn; only those as long as a pair or a window need
  a fingerprint of digests, the others are unique by their length;
* dedup: ``min_by`` per (conv, fingerprint): partial aggregation collapses copies
  before the shuffle;
* text: the ranges that are left (after dedup, cap and split) are exploded to one row per
  message and joined to the merged turns: exactly the output messages, never more.

Results are identical to the default plan (tested on the fixtures).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import null_safe_join, shared_table
from .samples import message_digest, range_fingerprint

BLOCK_TURNS = 1 << 14
# A conversation with more turns than this goes to the skew-safe plan.
HOT_TURNS = 100_000


def spread_runs(turns: DataFrame, block_size: int | None = None) -> DataFrame:
    """W2 without a per-conversation window: ``rid``, ``is_head`` and ``n_runs`` per turn."""
    block_size = block_size or BLOCK_TURNS
    t = turns.withColumn("block", F.floor(F.col("turn") / F.lit(block_size))).repartition("conv_id", "block")
    w = Window.partitionBy("conv_id", "block").orderBy("turn")
    t = (
        t.withColumn("_pos", F.row_number().over(w))
        .withColumn("_head_in", F.when(F.col("_pos") > 1, (F.col("role") != F.lag("role").over(w)).cast("int")).otherwise(F.lit(0)))
        .withColumn("_heads_upto", F.sum("_head_in").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    )
    summ = t.groupBy("conv_id", "block").agg(
        F.min_by("role", "turn").alias("_first_role"),
        F.max_by("role", "turn").alias("_last_role"),
        F.sum("_head_in").alias("_heads_in"),
    )
    ws = Window.partitionBy("conv_id").orderBy("block")
    summ = summ.withColumn(
        "_first_head", F.coalesce((F.col("_first_role") != F.lag("_last_role").over(ws)).cast("int"), F.lit(1))
    ).withColumn("_block_heads", F.col("_first_head") + F.col("_heads_in"))
    summ = summ.withColumn(
        "_heads_before", F.coalesce(F.sum("_block_heads").over(ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).withColumn(
        "n_runs", F.sum("_block_heads").over(ws.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ).withColumn("first_role", F.first("_first_role").over(ws.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    j = null_safe_join(t, summ.select("conv_id", "block", "_first_head", "_heads_before", "n_runs", "first_role"), ["conv_id", "block"])
    return j.select(
        "conv_id",
        "turn",
        "role",
        "content",
        F.when(F.col("_pos") == 1, F.col("_first_head") == 1).otherwise(F.col("_head_in") == 1).alias("is_head"),
        (F.col("_heads_before") + F.col("_first_head") + F.col("_heads_upto")).cast("int").alias("rid"),
        F.col("n_runs").cast("int").alias("n_runs"),
        "first_role",
    )


def blocked_lag(df: DataFrame, key: str, order: str, cols: Sequence[str], block_size: int | None = None) -> DataFrame:
    """``prev_<c>`` = ``lag(c)`` per ``key`` ordered by ``order`` without a per-key window:
    lag within (key, block); a block's first row takes the last row of the previous
    non-empty block from a table of block tails (one row per block)."""
    block_size = block_size or BLOCK_TURNS
    t = df.withColumn("_blk", F.floor(F.col(order) / F.lit(block_size))).repartition(key, "_blk")
    w = Window.partitionBy(key, "_blk").orderBy(order)
    t = t.withColumn("_first", F.row_number().over(w) == 1)
    for c in cols:
        t = t.withColumn(f"prev_{c}", F.lag(c).over(w))
    tails = t.groupBy(key, "_blk").agg(F.max_by(F.struct(*cols), F.col(order)).alias("_tail"))
    tails = tails.select(key, "_blk", F.lag("_tail").over(Window.partitionBy(key).orderBy("_blk")).alias("_prev_tail"))
    j = null_safe_join(t, tails, [key, "_blk"])
    for c in cols:
        j = j.withColumn(f"prev_{c}", F.when(F.col("_first"), F.col("_prev_tail")[c]).otherwise(F.col(f"prev_{c}")))
    return j.drop("_blk", "_first", "_prev_tail")


def blocked_row_number(df: DataFrame, key: str, order: Sequence[str], block: Column, out: str) -> DataFrame:
    """``out`` = 1-based place of each row of ``key`` in ``order`` without a per-key window:
    numbers within (key, block) plus the rows of earlier blocks, from a table of one row
    per block. ``block`` must not decrease along ``order``."""
    t = df.withColumn("_blk", block).repartition(key, "_blk")
    t = t.withColumn("_rn", F.row_number().over(Window.partitionBy(key, "_blk").orderBy(*order)))
    counts = t.groupBy(key, "_blk").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(key, "_blk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    j = null_safe_join(t, counts, [key, "_blk"])
    return j.withColumn(out, (F.col("_rn") + F.col("_before")).cast("long")).drop("_blk", "_rn", "_before")


def route_hot(turns: DataFrame, conversation_plan, spread_plan, strategy: str = "auto", hot_turns: int | None = None, turn_counts: DataFrame | None = None) -> DataFrame:
    """Run ``conversation_plan`` (one task per conversation) or ``spread_plan``
    (skew-safe) per conversation size.

    ``auto`` counts turns per conversation (a partial aggregation), keeps the ids above
    ``hot_turns``, however many, as a table in the shared folder, and joins it back:
    matching conversations take the spread plan, the rest the conversation plan. A NULL
    id is a conversation like any other in both plans. ``turn_counts (conv_id, n)`` replaces the
    count where upper bounds are cheaper to get than ``turns``.
    """
    if strategy == "conversation":
        return conversation_plan(turns)
    if strategy == "spread":
        return spread_plan(turns)
    if strategy != "auto":
        raise ValueError("strategy must be 'auto', 'conversation' or 'spread'")
    limit = HOT_TURNS if hot_turns is None else hot_turns
    if turn_counts is None:
        turn_counts = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    hot = turn_counts.where(F.col("n") > limit).select("conv_id")
    if hot.isEmpty():
        return conversation_plan(turns)
    hot = shared_table(hot, "hot-conversations")
    normal = null_safe_join(turns, hot, ["conv_id"], "left_anti")
    heavy = null_safe_join(turns, hot, ["conv_id"], "left_semi")
    return conversation_plan(normal).unionByName(spread_plan(heavy))


def _msg(role: Column, content: Column) -> Column:
    return F.struct(role.alias("role"), content.alias("content"))


def _run_rows(rt: DataFrame) -> DataFrame:
    """One row per run. (A run's text is one value by definition.)"""
    return rt.groupBy("conv_id", "rid").agg(
        F.min("role").alias("role"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "content"))), lambda x: x["content"]), "\n").alias("content"),
        F.min_by("content", "turn").alias("head_content"),
        F.min("n_runs").alias("n_runs"),
        F.min("first_role").alias("first_role"),
    )


def _merged_rows(runs: DataFrame) -> DataFrame:
    """``(conv_id, idx, role, content, n)``."""
    lead_model = (F.col("first_role") == "model").cast("int")
    return runs.where(~((F.col("rid") == 1) & (F.col("role") == "model"))).select(
        "conv_id",
        (F.col("rid") - 1 - lead_model).cast("int").alias("idx"),
        "role",
        "content",
        (F.col("n_runs") - lead_model).cast("int").alias("n"),
    )


def spread_merged(turns: DataFrame, block_size: int | None = None) -> DataFrame:
    """W2+W3+W4 without gathering a conversation: ``(conv_id, idx, role, content, n)``."""
    return _merged_rows(_run_rows(spread_runs(turns, block_size)))


def _pair_rows(turns: DataFrame, pair_mode: str, block_size: int | None, text: bool) -> DataFrame:
    """W5 by keyed joins: ``(conv_id, turn, u, m)``, the texts or the digests of both messages."""
    rt = spread_runs(turns, block_size)
    runs = _run_rows(rt)

    def value(role: str, col: str) -> Column:
        return F.expr(col if text else message_digest(repr(role), col))

    users = rt.where(F.col("role") == "user").select("conv_id", "turn", "rid", "is_head", value("user", "content").alias("own"))
    reply = "content" if pair_mode == "observed" else "head_content"
    nxt = runs.where(F.col("role") == "model").select("conv_id", (F.col("rid") - 1).alias("rid"), value("model", reply).alias("m"))
    p = null_safe_join(users, nxt, ["conv_id", "rid"])
    if pair_mode == "observed":
        p = null_safe_join(p, runs.select("conv_id", "rid", value("user", "content").alias("merged")), ["conv_id", "rid"])
        return p.select("conv_id", "turn", F.when(F.col("is_head"), F.col("merged")).otherwise(F.col("own")).alias("u"), "m")
    return p.select("conv_id", "turn", F.col("own").alias("u"), "m")


def _narrow(df: DataFrame, method: Column, ord_: int, start: Column, n: Column, fp: Column) -> DataFrame:
    return df.select(
        "conv_id", method.alias("method"), F.lit(ord_).cast("int").alias("method_ord"), start.cast("long").alias("start_idx"), n.cast("int").alias("n_msgs"), fp.alias("fp")
    )


def _window_ranges(digests: DataFrame, kind: str, ord_: int, size: int, step: int) -> DataFrame:
    """Windows of ``size`` messages that end at a model turn ``e`` (odd index) and start at a
    multiple of ``step``: each digest is copied to the windows that hold it."""
    last = F.col("n") - 1 - (F.col("n") % 2)  # last model index (odd); n < 2 -> none
    first_odd = F.col("idx") + (1 - F.col("idx") % 2)
    min_end = size - 1 if size % 2 == 0 else size  # ends are odd (model) indexes
    lo, hi = F.greatest(first_odd, F.lit(min_end)), F.least(F.col("idx") + size - 1, last)
    x = digests.select("conv_id", "idx", "digest", F.explode(F.when(hi >= lo, F.sequence(lo, hi, F.lit(2)))).alias("e"))
    x = x.where((F.col("e") - size + 1) % step == 0)
    g = x.groupBy("conv_id", "e").agg(F.expr(range_fingerprint("transform(array_sort(collect_list(struct(idx, digest))), x -> x.digest)")).alias("fp"))
    return _narrow(g, F.lit(kind), ord_, F.col("e") - size + 1, F.lit(size), F.col("fp"))


def _prefix_ranges(digests: DataFrame, ord_: int, shared: Sequence[int]) -> DataFrame:
    """Prefixes of even length; those of a ``shared`` length get a fingerprint of digests."""
    lengths = sorted({int(x) for x in shared if int(x) > 0 and int(x) % 2 == 0})
    ends = digests.where(F.col("idx") % 2 == 1)
    unique = ends.where(~(F.col("idx") + 1).isin(lengths)) if lengths else ends
    out = _narrow(unique, F.lit("prefix"), ord_, F.lit(0), F.col("idx") + 1, F.concat(F.lit("#"), F.col("idx") + 1))
    if not lengths:
        return out
    held = F.filter(F.array(*[F.lit(x) for x in lengths]), lambda x: (x > F.col("idx")) & (x <= F.col("n")))
    x = digests.where(F.col("idx") < max(lengths)).select("conv_id", "idx", "digest", F.explode(held).alias("l"))
    g = x.groupBy("conv_id", "l").agg(F.expr(range_fingerprint("transform(array_sort(collect_list(struct(idx, digest))), x -> x.digest)")).alias("fp"))
    return out.unionByName(_narrow(g, F.lit("prefix"), ord_, F.lit(0), F.col("l"), F.col("fp")))


def _first_of_equals(ranges: DataFrame, dedup: bool) -> DataFrame:
    """D1 as an aggregation: first range per (conv, fingerprint); copies combine map-side."""
    if dedup:
        order = F.struct("method_ord", "start_idx", "n_msgs")
        keep = F.struct("method", "method_ord", "start_idx", "n_msgs")
        ranges = ranges.groupBy("conv_id", "fp").agg(F.min_by(keep, order).alias("s")).select("conv_id", "s.*")
    none = F.lit(None).cast("int")
    return ranges.select("conv_id", "method", "method_ord", "start_idx", "n_msgs", none.alias("ri"), none.alias("pos"))


def _digests(turns: DataFrame, block_size: int | None) -> DataFrame:
    merged = spread_merged(turns, block_size)
    # narrow, read by every method: worked out once
    return shared_table(merged.select("conv_id", "idx", "n", F.expr(message_digest("role", "content")).alias("digest")), "turn-digests")


def spread_ranges(
    turns: DataFrame,
    pairs: Sequence[int] = (8, 16),
    pair_mode: str = "observed",
    dedup: bool = True,
    block_size: int | None = None,
    methods: Sequence[str] = ("pair", "prefix", "window"),
) -> DataFrame:
    """U1 (+D1) without text and without gathering a conversation (``samples.sample_ranges``)."""
    digests = _digests(turns, block_size)
    parts = []
    if "pair" in methods:
        p = _pair_rows(turns, pair_mode, block_size, text=False)
        parts.append(_narrow(p, F.lit("pair"), 0, F.col("turn"), F.lit(2), F.expr(range_fingerprint("array(u, m)"))))
    if "prefix" in methods:
        parts.append(_prefix_ranges(digests, 1, (2, *(2 * int(p) for p in pairs))))
    if "window" in methods:
        parts += [_window_ranges(digests, f"window{p}", 2 + j, 2 * int(p), 2) for j, p in enumerate(pairs)]
    return _first_of_equals(reduce(lambda a, b: a.unionByName(b), parts), dedup)


def spread_strided_ranges(turns: DataFrame, sizes: Sequence[int] = (8, 16), overlap: int = 2, dedup: bool = True, block_size: int | None = None) -> DataFrame:
    """W8 without text and without gathering a conversation."""
    digests = _digests(turns, block_size)
    parts = [_prefix_ranges(digests, 0, sizes)]
    parts += [_window_ranges(digests, f"stride{int(s)}", 1 + j, int(s), max(2, int(s) - int(overlap))) for j, s in enumerate(sizes) if int(s) > 0]
    return _first_of_equals(reduce(lambda a, b: a.unionByName(b), parts), dedup)


def spread_attach(ranges: DataFrame, turns: DataFrame, pair_mode: str = "observed", block_size: int | None = None) -> DataFrame:
    """``ranges`` plus ``messages``: pairs by their user turn, the others by one row per
    message, joined to the merged turns and grouped again by sample."""
    keys = ["conv_id", "method", "method_ord", "start_idx", "n_msgs"]
    extra = [c for c in ranges.columns if c not in keys]
    p = _pair_rows(turns, pair_mode, block_size, text=True).withColumnRenamed("turn", "start_idx")
    pair = null_safe_join(ranges.where("method = 'pair'"), p, ["conv_id", "start_idx"])
    pair = pair.select(*keys, F.array(_msg(F.lit("user"), F.col("u")), _msg(F.lit("model"), F.col("m"))).alias("messages"), *extra)
    rest = ranges.where("method <> 'pair'")
    at = rest.select(*keys, *extra, F.explode(F.expr("sequence(int(start_idx), int(start_idx + n_msgs - 1))")).alias("idx"))
    merged = spread_merged(turns, block_size).select("conv_id", "idx", "role", "content")
    x = null_safe_join(at, merged, ["conv_id", "idx"])
    # a sample is one row of the output by definition
    g = x.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("idx", "role", "content"))).alias("a"), *[F.first(c).alias(c) for c in extra])
    return pair.unionByName(g.select(*keys, F.transform("a", lambda m: _msg(m["role"], m["content"])).alias("messages"), *extra))


def spread_samples(
    turns: DataFrame,
    pairs: Sequence[int] = (8, 16),
    pair_mode: str = "observed",
    dedup: bool = True,
    block_size: int | None = None,
    methods: Sequence[str] = ("pair", "prefix", "window"),
) -> DataFrame:
    """U1 (+D1) with no per-conversation gathering; same rows as ``conversational_samples``.
    ``methods`` picks the sample kinds: W5 ``pair``, W6 ``prefix``, W7 ``window``."""
    if pair_mode not in ("observed", "raw"):
        raise ValueError(f"pair_mode must be 'observed' or 'raw', got {pair_mode!r}")
    ranges = shared_table(spread_ranges(turns, pairs, pair_mode, dedup, block_size, methods).drop("ri", "pos"), "sample-ranges")
    return spread_attach(ranges, turns, pair_mode, block_size)


def spread_strided(turns: DataFrame, sizes: Sequence[int] = (8, 16), overlap: int = 2, dedup: bool = True, block_size: int | None = None) -> DataFrame:
    """W8 without gathering a conversation (same rows as ``samples.strided_windows``)."""
    ranges = shared_table(spread_strided_ranges(turns, sizes, overlap, dedup, block_size).drop("ri", "pos"), "sample-ranges")
    return spread_attach(ranges, turns, block_size=block_size)

"""Training samples from merged conversations.

Data flow (one hash exchange on ``conv_id`` for everything):

    turns --window(lag, running sum)--> runs --agg(conv_id, rid)--> merged runs
        merged runs --agg(conv_id)--> one row: runs, message array, message digests
        row --ranges with fingerprints (W5-W8)--> first of equals (D1) --explode--> text

A sample is a range (method, start, length) of the merged list, or a pair. Its
fingerprint comes from message digests alone: samples of one length can only be equal if
that length occurs in more than one range, so pairs and windows hash their digests (a
bounded number) and a prefix of any other length is unique by its length. So ranges are
deduplicated, keyed, capped and split as narrow rows (``sample_ranges``), and
``attach_messages`` gives text to those that are left; the quadratic text of the prefixes
exists only in the output.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.render import messages_md5
from ..session import null_safe_join, shared_table
from .sequence import merge_runs, role_runs

SAMPLE_COLUMNS = ["conv_id", "method", "method_ord", "start_idx", "n_msgs", "messages"]
RANGE_COLUMNS = ["conv_id", "method", "method_ord", "start_idx", "n_msgs"]


def message_digest(role: str, content: str) -> str:
    """SQL for the digest of one message; all plans must agree on it."""
    return f"sha2(concat({role}, coalesce(concat(':', {content}), '')), 256)"


def range_fingerprint(digests: str) -> str:
    """SQL for the fingerprint of an ordered list of message digests."""
    return f"md5(array_join({digests}, ''))"


def conversation_rows(turns: DataFrame) -> DataFrame:
    """One row per conversation, built once and shared by every sample method.

    ``runs``: ``array<struct<rid, role, content, head_content, items, digest>>`` in order
    (W2+W3); ``msgs``: the merged list with one leading model run dropped (W4), as
    ``array<struct<role, content>>``; ``n`` = its size; ``run_digests`` and ``digests``:
    the message digests of both.
    """
    runs = merge_runs(role_runs(turns, strategy="conversation")).withColumn("digest", F.expr(message_digest("role", "content")))
    leading = "runs[0].role = 'model'"
    return (
        runs.groupBy("conv_id")
        .agg(F.expr("sort_array(collect_list(struct(rid, role, content, head_content, items, digest)))").alias("runs"))
        .selectExpr(
            "conv_id",
            "runs",
            "transform(filter(runs, r -> NOT (r.rid = 1 AND r.role = 'model')),"
            " r -> named_struct('role', r.role, 'content', r.content)) AS msgs",
            "runs.digest AS run_digests",
        )
        .selectExpr("*", "size(msgs) AS n", f"CASE WHEN {leading} THEN slice(run_digests, 2, size(runs)) ELSE run_digests END AS digests")
    )


# A sample descriptor: small values that say which messages a sample holds. The
# text is attached per output row afterwards, so a conversation's samples are
# never materialised together (prefixes are quadratic in conversation length).
# The field order is the order of D1: equal fingerprints together, first method first.
# Built as SQL text: one parse on the JVM instead of hundreds of py4j calls.
_DESC_ARRAY = "array<struct<fp:string,method_ord:int,start_idx:bigint,n_msgs:int,method:string,ri:int,pos:int>>"
_EMPTY = f"CAST(array() AS {_DESC_ARRAY})"
_NO_FP = re.compile(r"'fp', .*?, 'method_ord'")  # without D1 no digest is computed


def _desc_sql(method: str, ord_: int | str, start: str, length: str, ri: str = "-1", pos: str = "-1", fp: str = "CAST(NULL AS STRING)") -> str:
    return (
        f"named_struct('fp', {fp}, 'method_ord', CAST({ord_} AS INT), 'start_idx', CAST({start} AS BIGINT),"
        f" 'n_msgs', CAST({length} AS INT), 'method', {method}, 'ri', CAST({ri} AS INT), 'pos', CAST({pos} AS INT))"
    )


def _seq_sql(start: str, stop: str, step: int, guard: str) -> str:
    return f"CASE WHEN {guard} THEN sequence({start}, {stop}, {step}) ELSE CAST(array() AS array<int>) END"


def _slice_fp(start: str, length: str) -> str:
    return range_fingerprint(f"slice(digests, CAST({start} + 1 AS INT), {length})")


def _pair_sql(pair_mode: str) -> str:
    if pair_mode == "observed":
        # The first user turn of a run carries the merged run; the reply carries the merged model run.
        user = f"CASE WHEN p = 0 THEN get(run_digests, i) ELSE {message_digest(repr('user'), 'it.content')} END"
        model = "get(run_digests, i + 1)"
    else:
        user = message_digest(repr("user"), "it.content")
        model = message_digest(repr("model"), "get(runs, i + 1).head_content")
    per_item = _desc_sql("'pair'", 0, "it.turn", "2", "i", "p", range_fingerprint(f"array({user}, {model})"))
    return (
        f"flatten(transform({_seq_sql('0', 'size(runs) - 1', 1, 'size(runs) >= 1')}, i ->"
        f" CASE WHEN get(runs, i).role = 'user' AND i + 1 < size(runs)"
        f" THEN transform(get(runs, i).items, (it, p) -> {per_item}) ELSE {_EMPTY} END))"
    )


def _prefix_sql(method_ord: int, even_only: bool, shared: Sequence[int]) -> str:
    """``shared``: the lengths that samples of other methods may have, too."""
    top = "(n - n % 2)" if even_only else "n"
    lengths = ", ".join(str(int(x)) for x in sorted({*shared, 0}))
    fp = f"CASE WHEN l IN ({lengths}) THEN {_slice_fp('0', 'l')} ELSE concat('#', l) END"
    return f"transform({_seq_sql('2', top, 2, f'{top} >= 2')}, l -> {_desc_sql(repr('prefix'), method_ord, '0', 'l', fp=fp)})"


def _window_sql(pairs: Sequence[int], first_ord: int) -> list[str]:
    out = []
    for j, p in enumerate(pairs):
        size = 2 * int(p)
        seq = _seq_sql("0", f"n - {size}", 2, f"n >= {size}")
        out.append(f"transform({seq}, s -> {_desc_sql(repr(f'window{p}'), first_ord + j, 's', str(size), fp=_slice_fp('s', str(size)))})")
    return out


def _stride_sql(sizes: Sequence[int], overlap: int, first_ord: int) -> list[str]:
    out = []
    for j, size in enumerate(sizes):
        size = int(size)
        if size <= 0:
            continue
        step = max(2, size - int(overlap))
        seq = _seq_sql("0", f"(n - n % 2) - {size}", step, f"(n - n % 2) >= {size}")
        starts = f"filter({seq}, s -> get(msgs, s + {size - 1}).role = 'model')"
        out.append(f"transform({starts}, s -> {_desc_sql(repr(f'stride{size}'), first_ord + j, 's', str(size), fp=_slice_fp('s', str(size)))})")
    return out


def _concat_sql(parts: list[str]) -> str:
    return parts[0] if len(parts) == 1 else f"concat({', '.join(parts)})" if parts else _EMPTY


def _check_mode(pair_mode: str) -> None:
    if pair_mode not in ("observed", "raw"):
        raise ValueError(f"pair_mode must be 'observed' or 'raw', got {pair_mode!r}")


def _methods_sql(methods: Sequence[str], pairs: Sequence[int], pair_mode: str) -> str:
    """W5, W6, W7 in generation order, with fingerprints."""
    parts = [_pair_sql(pair_mode)] if "pair" in methods else []
    if "prefix" in methods:
        parts.append(_prefix_sql(1, False, (2, *(2 * int(p) for p in pairs))))
    if "window" in methods:
        parts += _window_sql(pairs, 2)
    return _concat_sql(parts)


def _strided_sql(sizes: Sequence[int], overlap: int) -> str:
    return _concat_sql([_prefix_sql(0, True, [s for s in sizes if int(s) > 0]), *_stride_sql(sizes, overlap, 1)])


def _exploded(conv_rows: DataFrame, descriptors: str, dedup: bool, payload: Sequence[str]) -> DataFrame:
    """One row per sample descriptor ``d``. D1 within the conversation's row: descriptors in
    (fingerprint, method, start, length) order, the first of each fingerprint stays."""
    if not dedup:
        descriptors = _NO_FP.sub("'fp', CAST(NULL AS STRING), 'method_ord'", descriptors)
    rows = conv_rows.select("conv_id", *payload, F.expr(descriptors).alias("ds"))
    if dedup:
        rows = rows.select("conv_id", *payload, F.sort_array("ds").alias("ds"))
        rows = rows.select("conv_id", *payload, F.expr("explode(filter(ds, (d, i) -> i = 0 OR d.fp <> get(ds, i - 1).fp))").alias("d"))
        return rows
    return rows.select("conv_id", *payload, F.explode("ds").alias("d"))


_RANGE = ["d.method AS method", "d.method_ord AS method_ord", "d.start_idx AS start_idx", "d.n_msgs AS n_msgs"]


def _messages_sql(pair_mode: str) -> str:
    if pair_mode == "observed":
        user_text = "CASE WHEN d.pos = 0 THEN get(runs, d.ri).content ELSE get(get(runs, d.ri).items, d.pos).content END"
        model_text = "get(runs, d.ri + 1).content"
    else:
        user_text = "get(get(runs, d.ri).items, d.pos).content"
        model_text = "get(runs, d.ri + 1).head_content"
    pair_msgs = (
        f"array(named_struct('role', 'user', 'content', {user_text}),"
        f" named_struct('role', 'model', 'content', {model_text}))"
    )
    return f"CASE WHEN d.method = 'pair' THEN {pair_msgs} ELSE slice(msgs, CAST(d.start_idx + 1 AS INT), d.n_msgs) END"


def materialise_samples(conv_rows: DataFrame, descriptors: str, pair_mode: str = "observed", dedup: bool = False) -> DataFrame:
    """Explode descriptors and attach the messages of each sample (one row at a time)."""
    _check_mode(pair_mode)
    return _exploded(conv_rows, descriptors, dedup, ("runs", "msgs")).selectExpr("conv_id", *_RANGE, f"{_messages_sql(pair_mode)} AS messages")


def _ranges_of(conv_rows: DataFrame, descriptors: str, dedup: bool) -> DataFrame:
    return _exploded(conv_rows, descriptors, dedup, ()).selectExpr("conv_id", *_RANGE, "d.ri AS ri", "d.pos AS pos")


def _routed(
    turns: DataFrame, descriptors: str, strategy: str, hot_turns: int | None, pair_mode: str = "observed", dedup: bool = False,
    turn_counts: DataFrame | None = None, **spread,
) -> DataFrame:
    """Samples in the conversation plan, or for hot conversations in the spread plan."""
    from .spread import route_hot, spread_samples

    _check_mode(pair_mode)
    return route_hot(
        turns,
        lambda t: materialise_samples(conversation_rows(t), descriptors, pair_mode, dedup),
        lambda t: spread_samples(t, pair_mode=pair_mode, dedup=dedup, **spread),
        strategy,
        hot_turns,
        turn_counts,
    )


def block_pairs(turns: DataFrame, pair_mode: str = "observed", strategy: str = "auto", hot_turns: int | None = None) -> DataFrame:
    """W5 ("method 1"): every user turn of a user run followed by a model run gives a
    2-message sample.

    ``observed`` reproduces the produced files: the first user turn of a run carries
    the whole merged run and the reply carries the whole merged model run (the
    in-place merge edits the very turn objects the pairs point to); other user
    turns keep their own text. ``raw`` gives the documented 1:1 pairs: own text and
    the first turn of the following model run.
    """
    return _routed(turns, _methods_sql(("pair",), (), pair_mode), strategy, hot_turns, pair_mode, methods=("pair",))


def expanding_history(turns: DataFrame, strategy: str = "auto", hot_turns: int | None = None) -> DataFrame:
    """W6 ("method 2"): for every model turn at index i, messages[0..i] (floor(n/2) samples)."""
    return _routed(turns, _methods_sql(("prefix",), (), "observed"), strategy, hot_turns, methods=("prefix",))


def pair_windows(turns: DataFrame, pairs: Sequence[int] = (8, 16), strategy: str = "auto", hot_turns: int | None = None) -> DataFrame:
    """W7 ("method 3"): windows of 2P messages at starts 0, 2, 4, ... when n >= 2P.

    Merged lists alternate and start with a user turn, so every window is
    user-first and model-last.
    """
    return _routed(turns, _methods_sql(("window",), pairs, "observed"), strategy, hot_turns, pairs=pairs, methods=("window",))


def strided_windows(
    turns: DataFrame, sizes: Sequence[int] = (8, 16), overlap: int = 2, dedup: bool = True, strategy: str = "auto", hot_turns: int | None = None,
    turn_counts: DataFrame | None = None,
) -> DataFrame:
    """The general chunker: even-length prefixes of the list cut to even length,
    then windows of each size > 0 with step ``max(2, size - overlap)`` that end with a
    model turn; duplicates removed per conversation, first wins."""
    from .spread import route_hot, spread_strided

    return route_hot(
        turns,
        lambda t: materialise_samples(conversation_rows(t), _strided_sql(sizes, overlap), dedup=dedup),
        lambda t: spread_strided(t, sizes, overlap, dedup),
        strategy,
        hot_turns,
        turn_counts,
    )


def pool(*dfs: DataFrame) -> DataFrame:
    """Concatenate sample sets (UNION ALL by column name)."""
    dfs = [d for d in dfs if d is not None]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


METHODS = ("pair", "prefix", "window")


def conversational_samples(
    turns: DataFrame,
    pairs: Sequence[int] = (8, 16),
    pair_mode: str = "observed",
    dedup: bool = True,
    strategy: str = "auto",
    hot_turns: int | None = None,
    turn_counts: DataFrame | None = None,
) -> DataFrame:
    """U1 (+D1): block pairs, expanding prefixes and pair windows (in that order),
    deduplicated per conversation. ``turns`` must be placeholder-filled (``fill_blank``).

    ``strategy``:
      * ``conversation``: one exchange on ``conv_id``; two aggregates and one
        generator on that partitioning, with the dedup inside the conversation's row;
      * ``spread``: the skew-safe plan (``operators.spread``), no conversation is
        ever gathered in one row or task;
      * ``auto`` (default): conversations above ``hot_turns`` take the spread
        plan, the rest the conversation plan (``spread.route_hot``; ``turn_counts``
        may hold counts that are cheaper to get than from ``turns``).

    To cap or split samples, take ``sample_ranges`` and attach the text of the survivors.
    """
    return _routed(turns, _methods_sql(METHODS, pairs, pair_mode), strategy, hot_turns, pair_mode, dedup, turn_counts, pairs=pairs)


def sample_ranges(
    turns: DataFrame,
    pairs: Sequence[int] = (8, 16),
    pair_mode: str = "observed",
    dedup: bool = True,
    strategy: str = "auto",
    hot_turns: int | None = None,
    turn_counts: DataFrame | None = None,
) -> DataFrame:
    """U1+D1 without text: the rows of ``conversational_samples`` as ``(conv_id, method,
    method_ord, start_idx, n_msgs, ri, pos)``; ``ri`` and ``pos`` help to find a pair again
    (NULL from the spread plan). Linear in the turns, whatever the prefixes' length."""
    from .spread import route_hot, spread_ranges

    _check_mode(pair_mode)
    return route_hot(
        turns,
        lambda t: _ranges_of(conversation_rows(t), _methods_sql(METHODS, pairs, pair_mode), dedup),
        lambda t: spread_ranges(t, pairs, pair_mode, dedup),
        strategy,
        hot_turns,
        turn_counts,
    )


def attach_messages(ranges: DataFrame, turns: DataFrame, pair_mode: str = "observed") -> DataFrame:
    """``ranges`` (any rows of ``sample_ranges``, with any further columns) plus ``messages``.

    Only conversations that still have a range are read in full. Ranges of the spread
    plan (``ri`` NULL) get their messages by keyed joins, one row per message.
    """
    from .spread import spread_attach

    _check_mode(pair_mode)
    extra = [c for c in ranges.columns if c not in ("conv_id", "ri", "pos", "method", "method_ord", "start_idx", "n_msgs")]
    plain, spread = ranges.where("ri IS NOT NULL"), ranges.where("ri IS NULL")

    def wanted(some: DataFrame) -> DataFrame:
        return null_safe_join(turns, some.select("conv_id").distinct(), ["conv_id"], "left_semi")

    d = F.struct("method", "method_ord", "start_idx", "n_msgs", "ri", "pos").alias("d")
    joined = null_safe_join(plain.select("conv_id", *extra, d), conversation_rows(wanted(plain)).select("conv_id", "runs", "msgs"), ["conv_id"])
    out = joined.selectExpr("conv_id", *_RANGE, f"{_messages_sql(pair_mode)} AS messages", *extra)
    if spread.isEmpty():
        return out
    spread = shared_table(spread.drop("ri", "pos"), "sample-ranges")
    return out.unionByName(spread_attach(spread, wanted(spread), pair_mode))


def with_sample_id(df: DataFrame, cols: Sequence[str] = ("conv_id", "method", "start_idx", "n_msgs")) -> DataFrame:
    """A unique, deterministic row id (string) from lineage columns."""
    return df.withColumn("sample_id", F.concat_ws(":", *[F.col(c).cast("string") for c in cols]))


def sample_report(samples: DataFrame) -> DataFrame:
    """Scalar projection of conversational samples (no nested arrays)."""
    return samples.select(
        "conv_id", "method", "start_idx", "n_msgs", messages_md5("messages").alias("sample_md5")
    )


def prep_stats(stages: dict[str, DataFrame], key: str = "conv_id") -> DataFrame:
    """Per-conversation and total counts for each stage (``ROLLUP``); the total row has
    ``conv_id`` NULL and ``is_total`` true, so a NULL conversation id stays apart.
    Partial aggregation keeps the shuffle tiny."""
    parts = [
        df.rollup(key)
        .agg(F.count(F.lit(1)).alias("n"), (F.grouping(key) == 1).alias("is_total"))
        .select(F.lit(name).alias("stage"), F.col(key).alias("conv_id"), "n", "is_total")
        for name, df in stages.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)

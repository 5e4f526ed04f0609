"""Ordered per-conversation sequence operators.

All of them need the turns of one conversation in order, so they share a single
hash exchange on ``conv_id``: the windows below and the run aggregation use the
same partitioning (``(conv_id, rid)`` is clustered by ``conv_id``), and Spark
adds no second exchange. Windows spill to disk, so long conversations are
memory-safe; no per-conversation Python is involved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

def _conv() -> Window:
    return Window.partitionBy("conv_id").orderBy("turn")


def instruct_from_dialogue(turns: DataFrame, strategy: str = "auto", hot_turns: int | None = None, turn_counts: DataFrame | None = None) -> DataFrame:
    """A model turn pairs with the immediately preceding turn iff that is a user turn.

    ``turns`` must already be blank-free (``drop_blank``). Equals the pending-user
    state machine: later user text overwrites, a reply consumes it, extra replies
    find no user and are dropped. Hot conversations take a blocked ``lag``
    (``spread.route_hot``).
    """
    from .spread import blocked_lag, route_hot

    def conversation_plan(t: DataFrame) -> DataFrame:
        return t.select(
            "conv_id",
            "turn",
            "role",
            "content",
            F.lag("role").over(_conv()).alias("prev_role"),
            F.lag("content").over(_conv()).alias("prev_content"),
            F.lag("turn").over(_conv()).alias("prev_turn"),
        )

    def spread_plan(t: DataFrame) -> DataFrame:
        return blocked_lag(t.select("conv_id", "turn", "role", "content"), "conv_id", "turn", ["role", "content", "turn"])

    with_prev = route_hot(turns, conversation_plan, spread_plan, strategy, hot_turns, turn_counts)
    return (
        with_prev.select("conv_id", "turn", "role", "content", "prev_role", "prev_content", "prev_turn")
        .where((F.col("role") == "model") & (F.col("prev_role") == "user"))
        .select(
            "conv_id",
            F.col("prev_turn").alias("user_turn"),
            F.col("turn").alias("model_turn"),
            F.col("prev_content").alias("instruction"),
            F.col("content").alias("response"),
            F.lit(None).cast("string").alias("context"),
        )
    )


def role_runs(turns: DataFrame, strategy: str = "auto", hot_turns: int | None = None) -> DataFrame:
    """Gaps-and-islands. ``rid`` numbers maximal same-role runs from 1; ``is_head``
    marks the first turn of a run. ``strategy="auto"|"spread"`` sends hot
    conversations through the blocked form (``spread.spread_runs``)."""
    from .spread import route_hot, spread_runs

    cols = turns.columns

    def conversation_plan(t: DataFrame) -> DataFrame:
        head = F.coalesce(F.col("role") != F.lag("role").over(_conv()), F.lit(True))
        rid = F.sum(F.col("is_head").cast("int")).over(_conv().rowsBetween(Window.unboundedPreceding, 0))
        return t.withColumn("is_head", head).withColumn("rid", rid.cast("int"))

    def spread_plan(t: DataFrame) -> DataFrame:
        return spread_runs(t).select(*cols, "is_head", "rid")

    return route_hot(turns, conversation_plan, spread_plan, strategy, hot_turns)


def merge_runs(runs: DataFrame) -> DataFrame:
    """One row per run, contents joined by ``\\n`` in turn order.

    Output: ``conv_id, rid, role, content, head_turn, head_content, n_raw, items``
    where ``items`` is the run's ``array<struct<turn, content>>`` in order (used by
    block pairs; it is the same data the merged text is built from).
    """
    items = F.sort_array(F.collect_list(F.struct("turn", "content")))
    return (
        runs.groupBy("conv_id", "rid")
        .agg(F.min("role").alias("role"), items.alias("items"))
        .select(
            "conv_id",
            "rid",
            "role",
            F.array_join(F.transform("items", lambda x: x["content"]), "\n").alias("content"),
            F.col("items")[0]["turn"].alias("head_turn"),
            F.col("items")[0]["content"].alias("head_content"),
            F.size("items").alias("n_raw"),
            "items",
        )
    )


def trim_leading_model(merged: DataFrame) -> DataFrame:
    """Drop one leading model run so index 0 is a user turn; ``idx`` is the
    0-based position in the trimmed, strictly alternating list.

    Runs alternate, so whether a conversation starts with a model run follows
    from any row's (role, rid) parity; no extra window is needed.
    """
    starts_with_model = (F.col("role") == "user") == (F.col("rid") % 2 == 0)
    return merged.where(~((F.col("rid") == 1) & (F.col("role") == "model"))).withColumn(
        "idx", (F.col("rid") - 1 - starts_with_model.cast("int")).cast("int")
    )


def merged_turns(turns: DataFrame, strategy: str = "auto") -> DataFrame:
    """W2+W3+W4: the strictly alternating, user-first merged list of each conversation.
    Runs are grouped by (conv, rid), so with blocked run ids no step holds a whole
    conversation."""
    return trim_leading_model(merge_runs(role_runs(turns, strategy=strategy)))

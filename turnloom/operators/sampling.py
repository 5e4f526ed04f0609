"""Reproducible shuffle, cap, percent split and eval subsample.

The order is a key, not a physical shuffle: ``shuffle_key = md5(seed ':' sample_id)``
is deterministic, independent of partitioning and retries (a lost executor
recomputes exactly the same keys), and the same value in any SQL engine.

"First k rows in shuffle order" becomes "key <= k-th smallest key": the k-th key
is found by a distributed radix select over the hex digits of the key (each
round is one partial aggregation returning at most 65,536 bucket counts to the
driver), so no global sort, no single-partition window and no unbounded
``limit`` is ever planned.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from ..session import scratch_table

KEY = "shuffle_key"
TIE = "sample_id"
# Keys a radix round may bring to the driver to finish the selection.
FINISH_MAX = 20_000
DIGITS_PER_ROUND = 4


def shuffled(samples: DataFrame, seed: int | str = 0, id_col: str = TIE) -> DataFrame:
    """Attach ``shuffle_key``; ordering by ``(shuffle_key, sample_id)`` is the shuffle."""
    return samples.withColumn(KEY, F.md5(F.concat(F.lit(str(seed)), F.lit(":"), F.col(id_col).cast("string"))))


def _order(df: DataFrame) -> F.Column:
    return F.struct(F.col(KEY), F.col(TIE))


def kth_key(df: DataFrame, k: int) -> tuple[str, str] | None:
    """The k-th smallest ``(shuffle_key, sample_id)`` (1-based); None when there are fewer."""
    return kth_keys(df, [k]).get(k)


def order_keys(samples: DataFrame):
    """Context manager: the narrow ``(shuffle_key, sample_id)`` table written once to
    the shared checkpoint folder (removed afterwards); the threshold passes re-read
    ~70 bytes per row instead of recomputing the sample pipeline."""
    return scratch_table(samples.select(KEY, TIE), "order-keys")


def kth_keys(df: DataFrame, ks: list[int]) -> dict[int, tuple[str, str] | None]:
    """Several k-th smallest keys: a radix select that serves all of them. Each round
    counts the next four hex digits below the prefixes still open (at most 65,536
    counts each); a bucket of ``FINISH_MAX`` keys or fewer is brought to the driver and
    ranked. A full key names one id, so no round goes beyond 32 digits."""
    keys = df.select(KEY, TIE)
    out: dict[int, tuple[str, str] | None] = {k: None for k in ks}
    open_ = {("", k): [k] for k in ks if k > 0}  # (prefix, rank below it) -> the ks it answers
    while open_:
        buckets: dict[str, list] = {}
        for prefix in {p for p, _ in open_}:
            digit = F.substring(F.col(KEY), len(prefix) + 1, DIGITS_PER_ROUND)
            below = keys.where(F.col(KEY).startswith(prefix)) if prefix else keys
            buckets[prefix] = below.groupBy(digit.alias("b")).count().orderBy("b").collect()
        nxt: dict[tuple[str, int], list[int]] = {}
        for (prefix, rank), wanted in open_.items():
            for r in buckets[prefix]:
                if rank > r["count"]:
                    rank -= r["count"]
                    continue
                found = prefix + r["b"]
                if r["count"] <= FINISH_MAX:
                    rows = sorted((x[KEY], x[TIE]) for x in keys.where(F.col(KEY).startswith(found)).collect())
                    out.update({k: rows[rank - 1] for k in wanted})
                elif len(found) >= 32:
                    one = keys.where(F.col(KEY) == found).first()
                    out.update({k: (one[KEY], one[TIE]) for k in wanted})
                else:
                    nxt.setdefault((found, rank), []).extend(wanted)
                break
        open_ = nxt
    return out


def _upto(df: DataFrame, bound: tuple[str, str] | None) -> F.Column:
    if bound is None:
        return F.lit(False)
    return _order(df) <= F.struct(F.lit(bound[0]).alias(KEY), F.lit(bound[1]).alias(TIE))


def cap(samples: DataFrame, max_samples: int | None) -> DataFrame:
    """R2: keep the first ``max_samples`` in shuffle order; 0/None = unlimited.

    ``samples`` must carry ``shuffle_key`` and ``sample_id``. Negative caps are
    rejected (a negative slice would count from the end).
    """
    if max_samples is not None and max_samples < 0:
        raise ValueError("max_samples must be >= 0 (0 or None = no cap)")
    if not max_samples:
        return samples
    with order_keys(samples) as keys:
        if keys.count() <= max_samples:
            return samples
        bound = kth_key(keys, max_samples)
    return samples.where(_upto(samples, bound))


def eval_size(n: int, percent: float) -> int:
    """k = ceil(n * (p / 100.0)) in IEEE double for 0 < p < 100, else 0 (n=100, p=7 gives 8)."""
    if not (0 < percent < 100):
        return 0
    return math.ceil(n * (percent / 100.0))


def split(samples: DataFrame, percent: float = 5, max_samples: int | None = None) -> tuple[DataFrame, DataFrame, dict]:
    """R2+R3: cap, then the first ``ceil(n*p/100)`` keys go to eval and the rest to train.

    Returns ``(train, eval, stats)``; both outputs are narrow filters on the key.
    """
    if max_samples is not None and max_samples < 0:
        raise ValueError("max_samples must be >= 0 (0 or None = no cap)")
    with order_keys(samples) as keys:
        n_all = keys.count()
        n = min(n_all, max_samples) if max_samples else n_all
        k = eval_size(n, percent)
        bounds = kth_keys(keys, [n if n < n_all else 0, k])
        cap_bound = bounds.get(n) if n < n_all else None
        eval_bound = bounds.get(k) if k > 0 else None
    in_cap = _upto(samples, cap_bound) if cap_bound is not None else F.lit(True)
    in_eval = _upto(samples, eval_bound)
    train = samples.where(in_cap & ~in_eval)
    evl = samples.where(in_eval)
    return train, evl, {"total": n_all, "capped": n, "eval": k, "train": n - k}


def eval_subsample(evl: DataFrame, n: int = 200, seed: int = 42, id_col: str = TIE) -> DataFrame:
    """More than ``n`` eval rows -> a fixed seeded subset of ``n``; else unchanged.

    A pure filter: rows keep their columns; the subset is the ``n`` smallest
    ``md5(seed ':' id)`` (ties by id).
    """
    sub = F.md5(F.concat(F.lit(str(seed)), F.lit(":"), F.col(id_col).cast("string")))
    keyed = evl.withColumn("_sub_key", sub)
    with scratch_table(keyed.select(F.col("_sub_key").alias(KEY), F.col(id_col).cast("string").alias(TIE)), "subsample-keys") as keys:
        if keys.count() <= n:
            return evl
        bound = kth_key(keys, n)
    order = F.struct(F.col("_sub_key").alias(KEY), F.col(id_col).cast("string").alias(TIE))
    limit = F.struct(F.lit(bound[0]).alias(KEY), F.lit(bound[1]).alias(TIE))
    return keyed.where(order <= limit).drop("_sub_key")


def eval_subsample_by_text(evl: DataFrame, n: int = 200, seed: int = 42, text_col: str = "text") -> DataFrame:
    """R4 for rows without an id: the same ``n`` rows however the files are split. The
    order is ``md5(seed ':' md5(text))``; rows of one text are equal, so it does not
    matter which of them fill the last places."""
    t = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    counts = evl.groupBy(t.alias(TIE)).agg(F.count(F.lit(1)).alias("n"))
    keyed = counts.withColumn(KEY, F.md5(F.concat(F.lit(f"{seed}:"), F.col(TIE))))
    with scratch_table(keyed, "subsample-texts") as texts:
        total = texts.agg(F.sum("n")).first()[0] or 0
        if total <= n:
            return evl
        bound = kth_key(texts, n)  # n texts are enough for n rows
        first = texts.where(_upto(texts, bound)) if bound else texts
        rows = sorted((r[KEY], r[TIE], r["n"]) for r in first.collect())  # n at most
    whole, left = [], n
    for _, text, count in rows:
        if count > left:
            break
        whole.append(text)
        left -= count
    else:
        text = None
    out = evl.where(t.isin(whole)) if whole else evl.where("false")
    return out.unionByName(evl.where(t == text).limit(left)) if left and text else out

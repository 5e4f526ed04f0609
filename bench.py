"""Benchmark the headline queries; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (full execution, nothing
collected). A first, untimed pass over all queries warms the JVM (class loading,
code generation, Python workers); the second pass is timed.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from turnloom.operators.normalise import fill_blank  # noqa: E402
from turnloom.operators.samples import conversational_samples, sample_report  # noqa: E402
from turnloom.plans.catalogue import QUERIES  # noqa: E402
from turnloom.plans.adapters import table  # noqa: E402
from turnloom.session import get_session  # noqa: E402
from turnloom.sources.tables import turns_from_table  # noqa: E402

HEADLINE = [
    "conversational_samples",
    "conversational_samples_conversations",
    "instruct_pairs",
    "strided_windows",
    "split_train",
    "encode",
    "truncate_pad_mask",
    "best_k_decisions",
    "best_k_prunes",
    "resolve_artifact",
    "json_docs_to_turns",
]


def replicated_conversations(spark, sf, times=100):
    """``conversations`` x ``times`` with fresh conversation ids (Spark-derived)."""
    c = table(spark, sf, "conversations")
    rep = c.select("*", F.explode(F.sequence(F.lit(0), F.lit(times - 1))).alias("copy"))
    return rep.withColumn("conv_id", F.col("conv_id") * times + F.col("copy")).drop("copy")


# The table whose rows drive each query (for rows/s).
DRIVING_TABLE = {
    "conversational_samples": "events", "instruct_pairs": "events", "strided_windows": "events",
    "split_train": "events", "best_k_decisions": "events", "best_k_prunes": "events",
    "conversational_samples_conversations": "conversations", "encode": "conversations",
    "truncate_pad_mask": "conversations", "resolve_artifact": "orders", "json_docs_to_turns": "conversations",
}


def _sf_value(sf_dir: str):
    tag = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        return float(tag)
    except ValueError:
        return tag


def run(df):
    df.write.format("noop").mode("overwrite").save()


def shuffle_bytes(log_dir: str) -> dict[str, int]:
    """Shuffle bytes written per job group, from Spark's event log (no UI involved)."""
    group_of_stage, out = {}, {}
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path, encoding="utf-8") as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        group_of_stage[sid] = g
                elif kind == "SparkListenerTaskEnd":
                    g = group_of_stage.get(ev.get("Stage ID"))
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    if g:
                        out[g] = out.get(g, 0) + int(m.get("Shuffle Bytes Written", 0))
    return out


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    log_dir = tempfile.mkdtemp(prefix="turnloom-eventlog-")  # scratch folder, local bench only
    spark = get_session(
        master=f"local[{cpus}]",
        shuffle_partitions=max(8, 2 * int(cpus)),
        extra_conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false"},
    )
    extra = {
        "conversational_samples_x100": lambda s, d: sample_report(
            conversational_samples(fill_blank(turns_from_table(replicated_conversations(s, d))))
        )
    }
    names = HEADLINE + list(extra)
    get = lambda n: extra[n] if n in extra else QUERIES[n]
    for n in names:  # warm-up, untimed
        run(get(n)(spark, sf))
    times = {}
    sc = spark.sparkContext
    for n in names:
        sc.setJobGroup(n, n)
        t0 = time.perf_counter()
        run(get(n)(spark, sf))
        times[n] = round(time.perf_counter() - t0, 3)
    sc.setJobGroup("done", "done")
    rows = {t: spark.read.parquet(f"{sf}/{t}.parquet").count() for t in set(DRIVING_TABLE.values()) | {"conversations"}}
    rows_per_sec = {n: round(rows[DRIVING_TABLE[n]] / times[n]) for n in names if n in DRIVING_TABLE}
    rows_per_sec["conversational_samples_x100"] = round(100 * rows["conversations"] / times["conversational_samples_x100"])
    spark.stop()
    shuffled_bytes = shuffle_bytes(log_dir)
    print(json.dumps({
        "metric": "headline_total_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": _sf_value(sf),
        "cpus": int(cpus),
        "input_rows_per_sec": rows_per_sec,
        "shuffle_bytes": {n: shuffled_bytes.get(n, 0) for n in names},
    }))


if __name__ == "__main__":
    main()

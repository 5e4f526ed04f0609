"""End-to-end: JSON folder -> train/eval JSONL -> model inputs."""

import json
import os
import tempfile

import pytest

from turnloom.plans.prepare import prepare_dataset, prepare_model_inputs


def write_folder():
    d = tempfile.mkdtemp(prefix="turnloom-in-")
    os.makedirs(f"{d}/nested")
    for i in range(30):
        conv = []
        for j in range(4):
            conv.append({"sender": "User", "userInput": f"question {i} {j}"})
            conv.append({"sender": "Claude", "claudeOutputText": f"answer {i} {j}"})
        json.dump(conv, open(f"{d}/nested/c{i}.json", "w"))
    json.dump([{"instruction": "say hi", "output": "hi"}, {"instruction": "x", "output": 3}], open(f"{d}/ins.json", "w"))
    open(f"{d}/broken.json", "w").write("{not json")
    return d


# conversational: 4 pairs + 4 prefixes per conversation, the 2-message prefix equals
# the first pair and is removed by the dedup -> 7
@pytest.mark.parametrize("fmt,n_total", [("instruct", 121), ("conversational", 30 * 7)])
def test_prepare_dataset(spark, fmt, n_total):
    src, out = write_folder(), tempfile.mkdtemp(prefix="turnloom-out-")
    res = prepare_dataset(spark, src, out, "d.jsonl", fmt, max_samples=100, validation_split=10)
    assert res.counts["total"] == n_total
    assert res.counts["capped"] == 100 and res.counts["eval"] == 10 and res.counts["train"] == 90
    assert res.valid == {"train": True, "eval": True}
    rejected = ["entry_non_string"] if fmt == "instruct" else ["skipped_shape"] * res.dropped.get("skipped_shape", 0)
    assert sorted(r.reason for r in res.quarantine.collect()) == sorted(["invalid_json", *rejected])
    assert sum(res.dropped.values()) == res.quarantine.count() and res.counts["train_validated"] == 90
    train = spark.read.json(res.paths["train"])
    assert train.count() == 90
    tr, ev, vocab = prepare_model_inputs(spark, res.paths["train"], res.paths["eval"], fmt, vocab_size=200, max_length=32, eval_rows=5)
    row = tr.first()
    assert len(row.input_ids) == 32 and len(row.labels) == 32 and len(row.attention_mask) == 32
    assert ev.count() == 5


def test_written_lines_follow_the_shuffle_order(spark):
    from pyspark.sql import functions as F

    from turnloom.operators.sampling import shuffled
    from turnloom.sources.jsonl import write_splits

    rows = [(f"id{i}", f"q{i}", "r", None) for i in range(500)]
    df = shuffled(spark.createDataFrame(rows, "sample_id string, instruction string, response string, context string"), 3)
    out = tempfile.mkdtemp(prefix="turnloom-order-")
    paths = write_splits(df, df.limit(0), out, "d.jsonl", "instruct")
    assert paths["eval"] is None
    lines = [json.loads(x)["instruction"] for f in sorted(os.listdir(paths["train"])) if f.startswith("part-") for x in open(f"{paths['train']}/{f}")]
    want = [r.instruction for r in df.orderBy("shuffle_key", "sample_id").select(F.col("instruction")).collect()]
    assert lines == want


def test_corrupt_lines_stop_the_job(spark):
    import pytest

    path = tempfile.mkdtemp(prefix="turnloom-corrupt-")
    with open(f"{path}/a.jsonl", "w") as f:
        f.write('{"instruction": "a", "response": "b", "context": null}\n{broken\n')
    with pytest.raises(ValueError, match="1 lines"):
        prepare_model_inputs(spark, path, fmt="instruct", vocab_size=50)


def test_eval_subset_is_the_same_for_any_split(spark):
    from turnloom.operators.sampling import eval_subsample_by_text

    texts = [f"t{i % 150}" for i in range(400)] + ["same"] * 300
    got = []
    for parts in (1, 3, 8):
        df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(parts)
        got.append(sorted(r.text for r in eval_subsample_by_text(df, 200).collect()))
        assert len(got[-1]) == 200 and eval_subsample_by_text(df, 700).count() == 700
    assert got[0] == got[1] == got[2]

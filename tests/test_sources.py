"""S1-S4, S6-S10, P6 and quarantine rules on temp folders (FIXTURES §3 #20-#28)."""

import json
import os
import tempfile

import pytest

from turnloom.sources.documents import (
    classify_docs,
    explode_entries,
    instruct_pairs,
    parse_docs,
    raw_docs,
    require_paths,
    scan_docs,
    to_turns,
)
from turnloom.sources.jsonl import read_samples, write_splits
from turnloom.sources.runlogs import list_artifacts, read_run_metrics


def docs(spark, texts):
    return raw_docs(spark.createDataFrame(list(enumerate(texts)), "k long, raw string"), "k", "raw")


def instruct(spark, texts):
    good, bad = parse_docs(docs(spark, texts))
    ent = explode_entries(classify_docs(good, "instruct"))
    pairs, rejects = instruct_pairs(ent)
    turns, q = to_turns(ent, "instruct")
    return pairs, rejects, turns, q, bad


def test_lone_instruction_object(spark):
    pairs, _, _, _, _ = instruct(spark, ['{"instruction":" i ","output":"o"}'])
    assert [(r.instruction, r.response, r.context) for r in pairs.collect()] == [("i", "o", None)]


def test_invalid_instruction_entries(spark):
    pairs, rejects, _, _, _ = instruct(spark, ['[{"instruction":"i","output":7},{"x":1},3]'])
    assert pairs.count() == 0
    assert sorted(r.reason for r in rejects.collect()) == ["malformed_entry", "malformed_entry", "non_string"]


def test_first_element_decides_shape(spark):
    pairs, _, turns, _, _ = instruct(spark, ['[{"instruction":"i","output":"o"},{"sender":"User","userInput":"a"}]'])
    assert [(r.instruction, r.response) for r in pairs.collect()] == [("i", "o")]
    assert turns.count() == 0


def test_null_sender_reads_as_dialogue(spark):
    pairs, _, turns, _, _ = instruct(spark, ['[{"sender":null},{"instruction":"i","output":"o"}]'])
    assert pairs.count() == 0 and turns.count() == 0


def test_conversational_skips_objects(spark):
    good, _ = parse_docs(docs(spark, ['{"sender":"User","userInput":"a"}']))
    assert classify_docs(good, "conversational").first().shape == "skip"


def test_quarantine_and_falsy(spark):
    texts = ["{broken", "﻿[1]", "[]", "{}", "null", "0", '""', "false", '[{"sender":"User"}]', '{"a":1,"a":2}']
    good, bad = parse_docs(docs(spark, texts))
    assert sorted(r.conv_id for r in bad.collect()) == ["0", "1"]
    assert sorted(r.conv_id for r in good.collect()) == ["8", "9"]


def test_non_object_entry_quarantines_document(spark):
    good, _ = parse_docs(docs(spark, ['[{"sender":"User","userInput":"a"}, 5]', '[{"sender":"User","userInput":7}]', '[{"sender":"User","userInput":"ok"}]']))
    turns, q = to_turns(explode_entries(classify_docs(good, "conversational")), "conversational")
    assert sorted((r.conv_id, r.reason) for r in q.collect()) == [("0", "non_object_entry"), ("1", "non_string_text")]
    assert [r.content for r in turns.collect()] == ["ok"]


def test_unicode_strip_and_roles(spark):
    good, _ = parse_docs(docs(spark, [json.dumps([{"sender": "User", "userInput": " a　"}, {"sender": "Claude", "claudeOutputText": "\tb\n", "userInput": "zzz"}, {"sender": "user", "userInput": "x"}])]))
    turns, _ = to_turns(explode_entries(classify_docs(good, "conversational")), "conversational")
    assert [(r.role, r.content) for r in turns.orderBy("turn").collect()] == [("user", "a"), ("model", "b")]


def test_scan_recursive_and_invalid_utf8(spark):
    d = tempfile.mkdtemp(prefix="turnloom-scan-")
    os.makedirs(f"{d}/sub")
    with open(f"{d}/a.json", "w") as f:
        f.write('[{"sender":"User","userInput":"a"},{"sender":"Claude","claudeOutputText":"b"}]')
    with open(f"{d}/sub/b.json", "w") as f:
        f.write('{"instruction":"i","output":"o"}')
    with open(f"{d}/sub/c.json", "wb") as f:
        f.write(b'{"instruction":"\xff","output":"o"}')
    with open(f"{d}/skip.txt", "w") as f:
        f.write("{}")
    raw = scan_docs(spark, d)
    assert raw.count() == 3
    good, bad = parse_docs(raw)
    assert [r.reason for r in bad.collect()] == ["invalid_utf8"]
    assert good.count() == 2


def test_scan_reads_hidden_names(spark, monkeypatch):
    from turnloom.sources import documents

    d = tempfile.mkdtemp(prefix="turnloom-hidden-")
    names = ["a.json", "_x.json", ".x.json", "s/_y.json", "s/h/.z.json", ".d/y.json", ".d/_e/w.json", "s/_d/hh/v.json", "_a=b.json", "_metadata.json", "_metadata/q.json", "_metadata/_q.json", "s/ü h/_u v.json"]
    for n in names:
        os.makedirs(os.path.dirname(f"{d}/{n}"), exist_ok=True)
        open(f"{d}/{n}", "w").write(json.dumps({"instruction": n, "output": "o"}))
    open(f"{d}/_skip.txt", "w").write("{}")
    got = [(r.path, json.loads(r.raw)["instruction"]) for r in scan_docs(spark, d).collect()]
    assert sorted(got) == sorted((f"file:{d}/{n}", n) for n in names)
    assert documents.count_docs(spark, d) == len(names)
    only = tempfile.mkdtemp(prefix="turnloom-hidden-")
    open(f"{only}/_x.json", "w").write("[1]" + " " * 20)
    assert scan_docs(spark, only).count() == 1
    open(f"{only}/_empty.json", "w").close()
    monkeypatch.setattr(documents, "VARIANT_LIMIT_BYTES", 10)
    assert sorted(r.reason for r in parse_docs(scan_docs(spark, only))[1].collect()) == ["invalid_json", "too_large"]


def test_missing_or_empty_folder(spark):
    with pytest.raises(FileNotFoundError):
        scan_docs(spark, "/nonexistent/turnloom")
    with pytest.raises(FileNotFoundError):
        scan_docs(spark, tempfile.mkdtemp(prefix="turnloom-empty-"))
    with pytest.raises(FileNotFoundError):
        require_paths(spark, "/nonexistent/x.jsonl")


def test_write_and_read_splits(spark):
    out = tempfile.mkdtemp(prefix="turnloom-out-")
    tr = spark.createDataFrame([("Привет", "ok", None)], "instruction string, response string, context string")
    ev = spark.createDataFrame([], "instruction string, response string, context string")
    os.makedirs(f"{out}/eval_d.jsonl")  # stale output from an earlier run
    paths = write_splits(tr, ev, out, "d.jsonl", "instruct")
    assert paths["eval"] is None and not os.path.exists(f"{out}/eval_d.jsonl")
    text = "".join(open(os.path.join(paths["train"], f), encoding="utf-8").read() for f in os.listdir(paths["train"]) if f.endswith(".json"))
    assert '"Привет"' in text and '"context":null' in text
    back = read_samples(spark, paths["train"], "instruct").collect()
    assert back[0].instruction == "Привет"


def test_run_metrics_and_artifacts(spark):
    root = tempfile.mkdtemp(prefix="turnloom-runs-")
    first = [{"step": 10, "loss": 2.0, "grad_norm": float("nan")}, {"step": 20, "eval_loss": 1.5}]
    for name, hist in [("checkpoint-20", first), ("checkpoint-40", first + [{"step": 40, "eval_loss": 1.2}])]:
        os.makedirs(f"{root}/run1/{name}/deep")
        open(f"{root}/run1/{name}/deep/adapter_config.json", "w").write("{}")
        json.dump({"log_history": hist}, open(f"{root}/run1/{name}/trainer_state.json", "w"))
        open(f"{root}/run1/{name}/adapter_config.json", "w").write("{}")
    m = read_run_metrics(spark, root)
    assert sorted((r.checkpoint, r.step, r.metric, str(r.value)) for r in m.collect()) == [
        ("checkpoint-40", 10, "grad_norm", "nan"), ("checkpoint-40", 10, "loss", "2.0"), ("checkpoint-40", 20, "eval_loss", "1.5"), ("checkpoint-40", 40, "eval_loss", "1.2")]
    for form in (f"{root}/run1", f"file:{root}/run1", f"file://{root}/run1/"):
        arts = list_artifacts(spark, form)
        assert sorted(r.path.rsplit("/", 1)[-1] for r in arts.collect()) == ["checkpoint-20", "checkpoint-40"]
    open(f"{root}/run1/checkpoint-40/trainer_state.json", "w").write("{broken")
    from turnloom.plans.report import report_folder
    from turnloom.sources.runlogs import parse_trainer_states

    r = report_folder(spark, root).first()
    assert (r.best_steps, r.artifact.rsplit("/", 1)[-1], r.n_evals) == ("20", "checkpoint-40", 1)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "trainer_state.json").load(root)
    assert [x.reason for x in parse_trainer_states(files)[1].collect()] == ["no_log_history"]


def test_unreadable_trainer_states_are_reported(spark):
    from turnloom.plans.report import report_folder

    root = tempfile.mkdtemp(prefix="turnloom-runs-")
    good = json.dumps({"log_history": [{"step": 10, "eval_loss": 1.0}]})
    for run, name, text in [("a", "checkpoint-10", good), ("a", "checkpoint-20", "{broken"), ("b", "checkpoint-5", "[]"), ("c", "checkpoint-10", good)]:
        os.makedirs(f"{root}/{run}/{name}")
        open(f"{root}/{run}/{name}/trainer_state.json", "w").write(text)
        open(f"{root}/{run}/{name}/adapter_config.json", "w").write("{}")
    got = {r.run_id.rsplit("/", 1)[-1]: (r.n_evals, r.n_unreadable) for r in report_folder(spark, root).collect()}
    assert got == {"a": (1, 1), "b": (None, 1), "c": (1, 0)}


def test_large_trainer_states_are_reported(spark, monkeypatch):
    from turnloom.plans.report import report_folder
    from turnloom.sources import runlogs

    root = tempfile.mkdtemp(prefix="turnloom-runs-")
    small = json.dumps({"log_history": [{"step": 10, "eval_loss": 1.0}]})
    for run, text in [("a", small), ("b", json.dumps({"log_history": [{"step": i, "eval_loss": 1.0} for i in range(90)]}))]:
        for name in ("checkpoint-10", "checkpoint-10/old", "checkpoint-9"):
            os.makedirs(f"{root}/{run}/{name}", exist_ok=True)
            open(f"{root}/{run}/{name}/adapter_config.json", "w").write("{}")
        open(f"{root}/{run}/checkpoint-10/trainer_state.json", "w").write(text)
    monkeypatch.setattr(runlogs, "STATE_LIMIT_BYTES", 500)
    got = {r.run_id.rsplit("/", 1)[-1]: (r.n_evals, r.n_unreadable, r.artifact and r.artifact.rsplit("/", 1)[-1]) for r in report_folder(spark, root).collect()}
    assert got == {"a": (1, 0, "checkpoint-10"), "b": (None, 1, None)}


@pytest.mark.parametrize("steps", [3, 10_000])
def test_trainer_state_files_are_bounded(spark, monkeypatch, steps):
    from turnloom.plans import adapters
    from turnloom.sources.runlogs import parse_trainer_states

    monkeypatch.setattr(adapters, "STATE_STEPS", steps, raising=False)
    kinds = ["view", "click", "purchase", "error", "signup", "other"]
    sizes = {1: 25_000 if steps > 3 else 25, 2: 1, 3: 4, None: 2}
    rows = [(i, u, f"2024-01-{1 + 20 * i // n:02d} 00:00:00", kinds[i % 6], float(i % 50)) for u, n in sizes.items() for i in range(n)]
    ev = spark.createDataFrame(rows, "event_id long, user_id long, ts string, event_type string, value double").selectExpr("event_id", "user_id", "CAST(ts AS timestamp) AS ts", "event_type", "value")
    files = adapters.trainer_states(ev).collect()
    assert max(len(json.loads(f.content)["log_history"]) for f in files) <= steps
    assert len({f.path for f in files}) == len(files) and any("c1/checkpoint-" + str((sizes[1] + 1) // 2) in f.path for f in files)
    got, bad = parse_trainer_states(spark.createDataFrame(files))
    want = []
    for u, n in sizes.items():
        if u:
            logged = [i for i in range(n) if kinds[i % 6] != "other"]
            for i in logged:
                metric = adapters.METRIC_OF_EVENT[kinds[i % 6]]
                want.append((f"runs/c{u}", f"checkpoint-{logged[-1] + 1}", i + 1, metric, "nan" if metric == "grad_norm" and i % 50 < 20 else str(float(i % 50))))
    assert sorted((r.run_id, r.checkpoint, r.step, r.metric, str(r.value)) for r in got.collect()) == sorted(want)
    assert bad.isEmpty()


def test_oversize_document_is_quarantined(spark, monkeypatch):
    from turnloom.sources import documents

    monkeypatch.setattr(documents, "VARIANT_LIMIT_BYTES", 10)
    good, bad = parse_docs(docs(spark, ['[{"sender":"User","userInput":"long enough"}]', "[1]"]))
    assert [(r.conv_id, r.reason) for r in bad.collect()] == [("0", "too_large")]
    assert [r.conv_id for r in good.collect()] == ["1"]


@pytest.mark.parametrize("text,ok", [
    ("8294 text", False), ('{"a":1} x', False), ("[1]]", False), ("1,0]", False), ('{"a":1}{"b":2}', False),
    (" [1, 2] \n", True), ('"s"', True), ("12", True), ('{"a":"\\u0001end"}', True), ("", False),
    ('1,"\\u0001end"] junk', False), ("null", True), (None, False),
])
def test_strict_json(spark, text, ok):
    from turnloom.functions.json import strict_parse_json

    r = strict_parse_json(spark.createDataFrame([(text,)], "t string"), "t", "v").selectExpr("v IS NOT NULL AS ok").first()
    assert r.ok == ok


def test_a_document_is_parsed_once(spark):
    good, _ = parse_docs(docs(spark, ['[{"sender":"User","userInput":"x"}]']))
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1

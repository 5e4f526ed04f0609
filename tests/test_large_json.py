"""Documents read in byte ranges give what the small-file path gives, on any cut."""

import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from turnloom.sources import documents
from turnloom.sources.documents import classify_docs, explode_entries, parse_docs, read_documents, scan_docs, to_turns
from turnloom.sources.large_json import large_entries, read_pieces


def text(rng):
    return "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", " ", "\n", "a", "é", "\U0001f600", "x}", '\\"', ":"]) for _ in range(rng.randrange(0, 30)))


def entry(rng):
    kind = rng.randrange(12)
    if kind == 0:
        return rng.choice([1, None, "s}", [], {}, [{"a": "}"}], True])
    if kind < 6:
        return {"sender": "User", "userInput": text(rng), "more": {"deep": [{"x": text(rng)}, []]}}
    return {"sender": rng.choice(["Claude", "System"]), "claudeOutputText": text(rng)}


def dump(rng, value):
    return json.dumps(value, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]), separators=rng.choice([(",", ":"), (" , ", " : ")]))


def documents_of(seed):
    rng = random.Random(seed)
    out = [dump(rng, [e for e in (entry(rng) for _ in range(rng.randrange(0, 25))) if isinstance(e, dict) or rng.random() < 0.2]) for _ in range(14)]
    out += ["[]", " [ ] ", "[1,2]", '[{"sender":"User","userInput":"a"}]  \n', '[{"instruction":"i","output":"o"},{"sender":"User"}]']
    good = '[{"sender":"User","userInput":"a}"},{"sender":"Claude","claudeOutputText":"b"}]'
    out += [good + "x", good + ",", good + "]", good[:-1], good[:-1] + ",]", "[," + good[1:], good.replace("},{", "}{"), good.replace("},{", "},,{"),
            good + good, "﻿" + good, good.replace('"b"', "b"), good.replace('"b"', '"b'), '[{"a":"\\}"}]', '["]","{"' + "]", good[:-1] + "],[" + good[1:]]
    return out


def folder(texts):
    d = tempfile.mkdtemp(prefix="turnloom-large-")
    for i, t in enumerate(texts):
        open(f"{d}/f +%{i:03d}.json", "wb").write(t if isinstance(t, bytes) else t.encode())
    return d


def outcome(entries, quarantine, fmt):
    got = entries.select("conv_id", "shape", "doc_reason", "turn", F.col("entry").cast("string").alias("e")).collect()
    turns, flawed = to_turns(entries, fmt)
    left_out = {(r.conv_id, r.reason) for r in quarantine.collect()} | {(r.conv_id, r.reason) for r in flawed.collect()}
    return sorted(map(tuple, got), key=str), sorted(map(tuple, turns.collect())), left_out


@pytest.mark.parametrize("seed,fmt,cut", [(1, "conversational", 120), (2, "instruct", 200), (3, "conversational", 333)])
def test_equal_to_small_files_on_any_cut(spark, seed, fmt, cut):
    d = folder([t for t in documents_of(seed) if t] + [b'[{"sender":"User","userInput":"\xff"}]'])
    good, bad = parse_docs(scan_docs(spark, d))
    classified = classify_docs(good, fmt)
    want = outcome(explode_entries(classified, fmt), bad.select("conv_id", "reason"), fmt)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(cut))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        pieces = read_pieces(spark, d, "*.json", 0)
        assert pieces.select("path", "block").distinct().count() > 40  # many ranges a file
        got = outcome(*large_entries(pieces, fmt), fmt)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got[:2] == want[:2]
    assert {k: v for k, v in got[2] if v != "large_not_a_list"} == {k: v for k, v in want[2] if (k, "large_not_a_list") not in got[2]}
    assert all(k in dict(want[2]) for k, v in got[2])


def test_folder_with_large_and_hidden_files(spark, monkeypatch):
    """What small and large files of one folder give together; nothing is too large."""
    texts = [t for t in documents_of(5) if t.lstrip().startswith("[")]
    d = folder(texts)
    os.makedirs(f"{d}/_h")
    for i, t in enumerate(texts[:4]):
        open(f"{d}/_h/.g{i}.json", "w").write(t)
    want = outcome(*read_documents(spark, d, "conversational"), "conversational")
    monkeypatch.setattr(documents, "VARIANT_LIMIT_BYTES", 300)
    from turnloom.sources import large_json

    entries, quarantine = read_documents(spark, d, "conversational")
    got = outcome(entries, quarantine, "conversational")
    small_enough = [(k, v) for k, v in got[2] if v == "entry_too_large"]
    assert not small_enough or all(v != "too_large" for _, v in got[2])
    keep = {k for k, v in small_enough}
    assert [r for r in got[1]] == [r for r in want[1] if r[0] not in keep]
    assert large_json.CHUNK_BLOCK


def test_turn_numbers_over_blocks_of_chunks(spark, monkeypatch):
    from turnloom.sources import large_json

    monkeypatch.setattr(large_json, "CHUNK_BLOCK", 4)
    rng = random.Random(8)
    values = [entry(rng) for _ in range(60)]
    d = folder([json.dumps(values)])
    entries, _ = large_entries(read_pieces(spark, d, "*.json", 0), "instruct")
    got = [(r.turn, json.loads(r.e)) for r in entries.select("turn", F.to_json("entry").alias("e")).orderBy("turn").collect()]
    assert got == list(enumerate(values))


def test_one_entry_above_the_limit(spark):
    d = folder(['[{"sender":"User","userInput":"%s"},{"sender":"Claude","claudeOutputText":"b"}]' % ("y" * 500)])
    entries, quarantine = large_entries(read_pieces(spark, d, "*.json", 0), "conversational", entry_limit=100)
    assert entries.isEmpty() and [r.reason for r in quarantine.collect()] == ["entry_too_large"]


def test_large_file_in_several_tasks(spark):
    """A 20 MB export with one long conversation: many ranges, all turns, in order."""
    d = tempfile.mkdtemp(prefix="turnloom-large-")
    n = 20_000
    with open(f"{d}/big.json", "w") as f:
        f.write("[")
        for i in range(n):
            e = {"sender": "User", "userInput": f"q{i} " + "lorem, {ipsum} " * 60} if i % 2 == 0 else {"sender": "Claude", "claudeOutputText": f"a{i} " + 'do "x" ' * 110}
            f.write(("," if i else "") + json.dumps(e))
        f.write("]")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        pieces = read_pieces(spark, d, "*.json", 0)
        assert pieces.rdd.getNumPartitions() >= 10
        entries, quarantine = large_entries(pieces, "conversational")
        turns, _ = to_turns(entries, "conversational")
        r = turns.agg(F.count("*").alias("n"), F.sum("turn").alias("s"), F.count_if(F.expr("split(content, ' ')[0] = concat(if(turn % 2 = 0, 'q', 'a'), turn)")).alias("ok")).first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert (r.n, r.s, r.ok) == (n, n * (n - 1) // 2, n) and quarantine.isEmpty()

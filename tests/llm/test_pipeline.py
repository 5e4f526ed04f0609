"""The stages on a small corpus against plain Python."""

from functools import cache

import corpus_pipeline as C
import public_tokenizers
import pyarrow as pa
import pytest

from tests.llm.test_decontaminate import naive as naive_leaks
from tests.llm.test_simhash import naive_components, naive_fingerprint
from tests.llm.test_suffix import naive as naive_spans
from tests.llm.test_tokens import naive_parts, naive_viterbi, spell
from turnloom.llm import decontaminate, langid, sentencepiece as P

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in C.STAGES:
        nxt = C.write_table(stage(spark, docs, SF), "test-stage")
        out.append(([tuple(r[c] for c in C.COLUMNS) for r in docs.collect()], nxt))
        docs = nxt
    return out


def by_id(rows):
    return sorted(rows, key=str)


def kept(step):
    return by_id(tuple(r[c] for c in C.COLUMNS) for r in step[1].collect())


def test_stages_are_in_order_and_return_the_columns(steps):
    assert [s[1].columns for s in steps[:-1]] == [C.COLUMNS] * 4
    assert len(C.STAGES) == 5


def test_language_stage_keeps_texts_with_letters(steps):
    assert kept(steps[0]) == by_id(r for r in steps[0][0] if any(c.isalpha() for c in r[1] or ""))


def test_simhash_stage_keeps_the_smallest_id_of_each_group(steps):
    rows = steps[1][0]
    comp = naive_components([naive_fingerprint(r[1]) for r in rows], 2)
    best = {}
    for r, c in zip(rows, comp):
        best[c] = min(best.get(c, r), r)
    assert kept(steps[1]) == by_id(best.values())


def test_suffix_stage_cuts_repeats(steps):
    rows = steps[2][0]
    want = [(r[0], s[4].decode("utf-8", "ignore"), r[2], r[3]) for r, s in zip(rows, naive_spans([r[1] for r in rows], 200))]
    assert kept(steps[2]) == by_id((*w, len(w[1])) for w in want)


def test_decontamination_stage_drops_leaks_only(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {r[0] for r in naive_leaks(steps[3][0], items) if r[-1]}
    assert kept(steps[3]) == by_id(r for r in steps[3][0] if r[0] not in leaked)


def test_encoding_stage(steps):
    p = P.Pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: list(r.ids) for r in steps[4][1].where("round_trip").collect()}
    path = cache(lambda u: spell(naive_viterbi(u, p), p))
    want = {r[0]: [i for u in naive_parts(r[1], p) for i in path(u)] for r in steps[4][0]}
    assert got == want


def test_run_and_odd_rows(spark):
    from tests.llm.data import DOCS, hostile_documents

    docs = spark.createDataFrame(hostile_documents(), DOCS)
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.where("NOT round_trip").count() == 0
    empty = spark.createDataFrame([], DOCS)
    for _, stage in C.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_batches_that_workers_send_are_bounded(spark, monkeypatch):
    """Language counts and marked documents come back slice by slice, not a whole input batch at once."""
    docs = spark.createDataFrame([(1, "x", "en")], "uid long, text string, lang string")

    class Given(Exception):
        pass

    def given(self, run, *rest):
        raise Given(run)

    def sent(call, batch):
        with monkeypatch.context() as m, pytest.raises(Given) as found:
            m.setattr(type(docs), "mapInArrow", given)
            call()
        return list(found.value.args[0](iter([batch])))

    texts = pa.array([f"word{i % 7} other{i % 5} " * 400 for i in range(2000)])  # over 10 MB
    got = sent(lambda: langid.learn(docs), pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), texts], ["lang", "text"]))
    assert len(got) > 2
    keep = [f for f in docs.schema.fields if f.name in ("uid", "text")]
    got = sent(lambda: decontaminate._fingerprints(docs.select("uid", "text"), keep, None, [], 10, 8), pa.RecordBatch.from_arrays([pa.array(range(len(texts))), texts], ["uid", "text"]))
    assert len(got) > 2 and [i for b in got for i in b.column(0).to_pylist()] == list(range(len(texts)))

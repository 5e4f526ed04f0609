import hashlib
import re

from tests.llm.data import DOCS, hostile_documents, words
from turnloom.llm import decontaminate as D


def toks(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def naive(docs, items, span=10):
    out = []
    for d in docs:
        w, hit, found = toks(d[1]), set(), set()
        for item, text in items:
            iw = toks(text)
            if not iw:
                continue
            n = min(span, len(iw))
            wins = {tuple(iw[s : s + n]) for s in range(max(1, len(iw) - n + 1))}
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in wins:
                    hit.update(range(s, s + n))
                    found.add(item)
        found.discard(None)
        listed = ",".join(sorted(str(x) for x in found))
        out.append((d[0], len(w), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items, **kw):
    got = D.decontaminate(spark.createDataFrame(docs, DOCS).withColumnRenamed("source", "n_words"), spark.createDataFrame(items, "item_id long, text string"), **kw)
    return sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got.collect()], key=str)


def test_against_brute_force(spark):
    import random

    rng = random.Random(9)
    docs = hostile_documents()
    items = [(i, words(rng, rng.randrange(8, 40), 300)) for i in range(20)]
    items += [(30, items[0][1]), (31, "w1 w2 w3"), (32, "w5"), (33, None), (34, "!!"), (None, items[1][1]), (35, words(rng, 8)), (36, words(rng, 10))]
    items += [(40, " ".join(docs[5][1].split()[3:30])), (41, docs[2][1]), (42, "W1, w2; W3"), (43, "a b c 123 z y")]
    for i, (item, text) in enumerate(items[:12]):
        t = (text or "").split()
        docs.append((600 + i, f"{words(rng, 9)} {' '.join(t[:9])}, {words(rng, 5)} {' '.join(t[-11:]).upper()}. {words(rng, 3)}", "en", "s", 1))
    want = naive(docs, items)
    assert run(spark, docs, items) == want
    assert sum(r[5] for r in want) > 5
    assert run(spark, docs, items, k=5, filter_bits=8) == want  # other k-grams, a saturated bitmap


def test_empty_tables(spark):
    docs = hostile_documents()
    assert run(spark, [], [(1, "w1 w2")]) == []
    assert run(spark, docs, []) == naive(docs, [])
    assert run(spark, docs, [(1, None), (2, "")]) == naive(docs, [])

"""Small hostile inputs shared by the tests."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocab=60):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


def hostile_documents(seed=5, n=60):
    """Nulls in every column, empty and odd texts, copies, near copies, repeated rows and ids."""
    rng = random.Random(seed)
    base = [words(rng, rng.randrange(1, 120), 400) for _ in range(n)]
    passage = words(rng, 70, 900)
    rows = [(i, t, "en" if i % 3 else "de", f"s{i % 4}", len(t)) for i, t in enumerate(base)]
    rows += [(100 + i, base[0], "en", "s0", 1) for i in range(5)]  # exact copies
    rows += [(200 + i, base[1] + f" x{i}", "en", "s0", 1) for i in range(4)]  # near copies
    rows += [(300 + i, f"{words(rng, 20)} {passage} {words(rng, 20)}", None, None, None) for i in range(3)]
    rows += [(400, None, "en", "s", 3), (401, "", "en", "s", 0), (402, " \t\n ", None, "s", 4), (403, "é" * 300, "fr", None, None)]
    rows += [(404, "aaaa" * 200, "en", "s", 1), (405, "\U0001f600 x " * 60, "en", "s", 1), (None, base[2], "en", "s", 1), (None, None, None, None, None)]
    rows += [rows[3], rows[3], (3, "another text under a used id", "en", "s", 1)]
    rows += [(406, "A,b;C! 123 \x00 \x0b z y", "en", "s", 1)]
    return rows

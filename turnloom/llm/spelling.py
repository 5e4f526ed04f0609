"""Spelling variant grouping by PartEnum signatures.

Words: one narrow pass counts the words of whole texts in each task, Spark sums them.

Near words (one code point inserted, deleted or replaced): a word's letters, with the
number of each occurrence (``e1 e2 t1``), are the ones of a binary vector. One edit
changes at most two of them, so near words have vectors at Hamming distance two or less.
PartEnum: the elements are dealt into ``parts`` parts by hash, and a word has one
signature for each choice of ``parts - 2`` of them: two differing elements touch at most
two parts, so near words agree on the signature of the others. One edit also leaves the
first or the last half of a word as it is; the half is part of the signature, which
keeps anagrams apart.

The equi-join: rows meet by signature, a window counts each group, and groups up to
``GROUP_LIMIT`` words verify their members inside one row. Words of larger groups are
dealt anew by more parts (``LEVELS``), whose signatures are longer; what is still large
at the last level goes through a keyed self-join, which AQE can split. No pair is lost
and no candidate pair leaves a group before it is verified.

Forms: every word looks at its near words' counts (``min`` of a struct, combined before
the shuffle); roots follow by pointer doubling, at most six rounds, since a form has ten
times its word's count.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window, functions as F

from ..session import ship_by_value
from .common import byte_views, mix64, write_table

ship_by_value(__name__)

MIN_LETTERS, MIN_COUNT, RATIO = 7, 2, 10
LEVELS = (4, 8, 16)
GROUP_LIMIT = 256
_CHARS_AT_ONCE = 1 << 20
_WORDS_AT_ONCE = 1 << 19
_CELLS_AT_ONCE = 1 << 19
_STEP = np.uint64(0x9E3779B97F4A7C15)
_RUN = re.compile("[a-zÀ-ÿ]+")
_GAP = re.compile("[^a-zÀ-ÿ]")


# ---------------------------------------------------------------- words
def _pieces(data: bytes) -> Iterator[str]:
    """A text, A-Z lower-cased, in pieces of bounded length that cut no word."""
    text = data.lower().decode()
    at = 0
    while at < len(text):
        end = at + _CHARS_AT_ONCE
        gap = _GAP.search(text, end) if end < len(text) else None
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end


def edited_words(doc_id: str, data: bytes, min_letters: int = 1) -> dict[str, int]:
    """The words of one text with their counts. ``h`` is the crc32 of ``<doc_id>:<run>``;
    if 31 divides it, the run loses its code point ``h % length``."""
    runs: Counter[str] = Counter()
    for piece in _pieces(data):
        runs.update(_RUN.findall(piece))
    start, out = zlib.crc32(doc_id.encode() + b":"), {}
    for w, n in runs.items():
        if len(w) < min_letters:
            continue
        h = zlib.crc32(w.encode(), start)
        if h % 31 == 0:
            at = h % len(w)
            w = w[:at] + w[at + 1 :]
            if len(w) < min_letters:
                continue
        out[w] = out.get(w, 0) + n
    return out


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)`` of all words with enough letters and occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}

        def flush() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])
            total.clear()
            return got

        for b in batches:
            for i, data in zip(b.column(0).to_pylist(), byte_views(b.column(1))):
                for w, n in edited_words(i or "", data, min_letters).items():
                    total[w] = total.get(w, 0) + n
                if len(total) >= _WORDS_AT_ONCE:
                    yield flush()
        if total:
            yield flush()

    src = docs.select(F.col(id_col).cast("string"), F.col(text_col))
    return src.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---------------------------------------------------------------- PartEnum signatures
def _code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of each word, as rows padded with zero, and the lengths."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    out = np.zeros((len(words), int(size.max(initial=1))), np.uint64)
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out, size


def _half_hash(cp: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the code points ``start <= place < end`` of each row and their places from ``start``."""
    at = np.arange(cp.shape[1])
    on = (at >= start[:, None]) & (at < end[:, None])
    place = np.where(on, at - start[:, None], 0).astype(np.uint64)
    return np.where(on, mix64((cp << np.uint64(32) | place) * _STEP), 0).sum(1, dtype=np.uint64)


def half_keys(cp: np.ndarray, size: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(rows, hash)`` of the halves that a near word may share. Of two near words whose
    longer one has m letters, the first or the last m // 2 agree; a word of odd length
    meets longer ones by (length + 1) / 2 letters, too."""
    out = []
    every, odd = np.arange(len(size)), np.flatnonzero(size % 2 == 1)
    for rows, q in ((every, size // 2), (odd, (size[odd] + 1) // 2)):
        c, n = cp[rows], size[rows]
        out.append((rows, mix64(_half_hash(c, np.zeros_like(n), q) + q.astype(np.uint64))))
        out.append((rows, mix64(_half_hash(c, n - q, n) ^ (q.astype(np.uint64) << np.uint64(32)))))
    return out


def signatures(cp: np.ndarray, size: np.ndarray, parts: int) -> Iterator[np.ndarray]:
    """The signature of every word, for each choice of all parts but two."""
    row = np.sort(cp, axis=1)[:, ::-1]  # letters together, padding last
    at = np.broadcast_to(np.arange(row.shape[1]), row.shape)
    new = np.concatenate([np.ones((len(row), 1), bool), row[:, 1:] != row[:, :-1]], axis=1)
    nth = (at - np.maximum.accumulate(np.where(new, at, 0), axis=1)).astype(np.uint64)
    element = mix64((row << np.uint64(32) | nth) * _STEP + np.uint64(1))
    element[row == 0] = 0
    part = (element >> np.uint64(40)) % np.uint64(parts)
    sums = [np.where(part == p, element, 0).sum(1, dtype=np.uint64) for p in range(parts)]
    whole = sum(mix64(s + np.uint64(p + 1)) for p, s in enumerate(sums))
    for i, j in itertools.combinations(range(parts), 2):
        rest = whole - mix64(sums[i] + np.uint64(i + 1)) - mix64(sums[j] + np.uint64(j + 1))
        yield mix64(rest ^ np.uint64((i << 8 | j) + 1))


def _slices(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges whose padded letters stay bounded; sizes rise."""
    at = 0
    while at < len(size):
        room = np.arange(1, len(size) - at + 1) * size[at:]
        end = at + max(1, int(np.searchsorted(room, _CELLS_AT_ONCE, "right")))
        yield at, end
        at = end


def _deal(words: DataFrame, parts: int) -> DataFrame:
    """``(key, half, word)``: the words by half and signature; ``half`` says which half."""
    chosen = "half" in words.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by_size = np.argsort(np.asarray(pa.compute.utf8_length(b.column(0))), kind="stable")
            b = b.take(pa.array(by_size))
            for at, end in _slices(np.asarray(pa.compute.utf8_length(b.column(0)))):
                w = b.column(0).slice(at, end - at)
                only = np.asarray(b.column(1).slice(at, end - at)) if chosen else None
                cp, size = _code_points(w.to_pylist())
                halves = half_keys(cp, size)
                for sig in signatures(cp, size, parts):
                    for h, (rows, key) in enumerate(halves):
                        k = mix64(key ^ sig[rows])
                        if only is not None:
                            on = only[rows] == h
                            rows, k = rows[on], k[on]
                        if len(rows):
                            yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(np.full(len(rows), h, np.int32)), w.take(pa.array(rows))], ["key", "half", "word"])

    return words.select("word", *(["half"] if chosen else [])).mapInArrow(run, "key long, half int, word string")


def one_edit(left: np.ndarray, right: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of different words (rows ``i``, ``j``; letters aligned left and right) are one
    edit apart: common beginning and common end leave at most one letter of the longer."""
    short, long = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
    same = []
    for letters in (left, right[:, ::-1]):
        differ = letters[i] != letters[j]
        first = np.where(differ.any(1), differ.argmax(1), letters.shape[1])
        same.append(np.minimum(first, short))
    return (long - short <= 1) & (same[0] + same[1] >= long - 1)


def _verified(groups: DataFrame) -> DataFrame:
    """``(x, y)`` of the near words inside each list ``w`` (sorted, distinct, of bounded length)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(0)
            flat = col.flatten()
            n = np.asarray(pa.compute.list_value_length(col)).astype(np.int64)
            begin = np.cumsum(n) - n
            for at, end in _slices_of(n * n):
                words = flat.slice(begin[at], begin[end - 1] + n[end - 1] - begin[at])
                left, size = _code_points(words.to_pylist())
                if left.max(initial=0) < 256:
                    left = left.astype(np.uint8)
                right = np.zeros_like(left)
                place = np.arange(left.shape[1])
                right[place >= left.shape[1] - size[:, None]] = left[place < size[:, None]]
                # every word with each later one of its group
                last = np.repeat(begin[at:end] - begin[at] + n[at:end], n[at:end])
                i = np.arange(len(size))
                more = last - i - 1
                u = np.repeat(i, more)
                v = np.arange(len(u)) - np.repeat(np.cumsum(more) - more, more) + u + 1
                near = np.abs(size[u] - size[v]) <= 1
                u, v = u[near], v[near]
                step = max(1, _CELLS_AT_ONCE * 4 // left.shape[1])
                for k in range(0, len(u), step):
                    ok = one_edit(left, right, size, u[k : k + step], v[k : k + step])
                    if ok.any():
                        yield pa.RecordBatch.from_arrays([words.take(pa.array(u[k : k + step][ok])), words.take(pa.array(v[k : k + step][ok]))], ["x", "y"])

    return groups.select("w").mapInArrow(run, "x string, y string")


def _slices_of(cost: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of bounded cost, at least one row each."""
    total, at = np.cumsum(cost), 0
    while at < len(cost):
        done = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, done + _CELLS_AT_ONCE, "right")))
        yield at, end
        at = end


_ONE_EDIT = "abs(length(x) - length(y)) <= 1 AND levenshtein(x, y, 1) = 1"


def near_pairs(words: DataFrame, levels: tuple[int, ...] = LEVELS, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """``(x, y)``, x < y: all pairs of distinct words that differ by exactly one inserted,
    deleted or replaced code point, each once."""
    found = []
    todo = words.select("word")
    for i, parts in enumerate(levels):
        sized = _deal(todo, parts).withColumn("g", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("g > 1")
        groups = sized.where(F.col("g") <= group_limit).groupBy("key").agg(F.array_sort(F.collect_set("word")).alias("w"))
        none, large = F.lit(None).cast("string"), sized.where(F.col("g") > group_limit)
        # pairs of the small groups and words of the large ones, written together
        got = _verified(groups).select("x", "y", F.lit(None).cast("int").alias("half"), F.lit(None).cast("long").alias("key"))
        got = write_table(got.unionByName(large.select(F.col("word").alias("x"), none.alias("y"), "half", "key")), "spelling-pairs")
        found.append(got.where("y IS NOT NULL").select("x", "y"))
        large = got.where("y IS NULL").select(F.col("x").alias("word"), "half", "key")
        if large.isEmpty():
            break
        if i < len(levels) - 1:
            todo = write_table(large.select("word", "half").distinct(), "spelling-large")
        else:
            a, b = large.select("key", F.col("word").alias("x")), large.select("key", F.col("word").alias("y"))
            found.append(a.join(b, "key").where("x < y").where(F.expr(_ONE_EDIT)).select("x", "y"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.distinct()


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, ratio: int = RATIO
) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of all words of ``docs``.

    ``form``: the near word of largest count (ties: first in code-point order) if its
    count is at least ``ratio`` times the word's, else NULL; ``root``: the end of the
    chain of forms, the word itself if it has none. NULL text has no words, a NULL id is
    spelled as nothing; repeated rows count as often as they stand there. Only the two
    named columns are read. Texts of any length are read whole, in pieces. An empty table
    gives no rows.
    """
    if ratio < 2:
        raise ValueError("a form's count must be at least twice the word's")
    words = write_table(count_words(docs, id_col, text_col, min_letters, min_count), "spelling-words")
    pairs = write_table(near_pairs(words), "spelling-near")
    both = pairs.select(F.col("x").alias("word"), F.col("y").alias("near")).unionByName(pairs.select(F.col("y").alias("word"), F.col("x").alias("near")))
    ranked = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = ranked.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("k"), "near")).alias("b"))
    got = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.expr(f"CASE WHEN -b.k >= {ratio} * n THEN b.near END").alias("form"), F.expr(f"CASE WHEN -b.k >= {ratio} * n THEN -b.k END").alias("form_n")
    )
    got = write_table(got, "spelling-forms")
    links = got.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    # Chains are short: counts rise by the ratio at each step, and 63 bits hold few steps.
    steps = 1
    while steps < 63 / math.log2(ratio):
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        links = write_table(links.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root")), "spelling-roots")
        steps *= 2
    out = got.join(links, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""Language identification by rank-order n-gram profiles.

A profile is the list of a language's most frequent character n-grams (n = 1 to 3, on
lower-cased letters, words padded with one space), most frequent first. A document is
compared with each profile by out-of-place distance: for each of its own most frequent
n-grams, how far its rank is from the rank in the profile, or the profile's full length
if it is not there. The smallest sum wins.

Learning counts all n-grams of all training texts: each task counts its rows into sorted
arrays, Spark sums per (language, n-gram) with partial aggregation, and a window keeps
the top of each language, so only ``profile_size`` rows per language reach the driver.
Scoring is one narrow pass with those profiles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..session import ship_by_value
from .common import append_columns, by_bytes, lean, worker_cache

ship_by_value(__name__)

PROFILE_SIZE = 400
MAX_N = 3
UNDETERMINED = "und"
_BITS = 21  # of a code point
_CHARS_AT_ONCE = 1 << 18
_BYTES_AT_ONCE = 4 << 20  # of texts held as strings


@dataclass(frozen=True)
class Profiles:
    """Languages in name order, and each known n-gram's rank in every profile."""

    langs: list[str]
    grams: np.ndarray  # sorted codes
    ranks: np.ndarray  # [gram, language], ``size`` where it is not in the profile
    size: int


def _letters() -> np.ndarray:
    cache = worker_cache("letters")
    if "is" not in cache:
        cache["is"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return cache["is"]


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_counts(texts: list[str], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``(group, code)`` in order, with counts, over all n-grams of the texts.

    A code holds up to three code points, first one highest, zero after a shorter
    n-gram, so codes sort like the n-grams do. ``groups`` must not decrease.
    """
    parts, owner = [], []
    for t, g in zip(texts, groups):
        if t:
            cp = _code_points(t)
            parts += [cp, np.array([32], np.uint32)]
            owner.append((g, len(cp) + 1))
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    cp = np.concatenate([np.array([32], np.uint32), *parts])
    grp = np.repeat(np.array([g for g, _ in owner], np.int64), [n for _, n in owner])
    grp = np.append(grp[:1], grp)
    letter = _letters()[cp]
    keep = letter | np.append(True, letter[:-1])  # one space between words
    cp, grp, letter = np.where(letter, cp, 32)[keep].astype(np.int64), grp[keep], letter[keep]
    seen = np.zeros(0x110000, bool)
    seen[cp] = True
    alphabet = np.flatnonzero(seen)
    dense = np.zeros(0x110000, np.int64)
    dense[alphabet] = np.arange(1, len(alphabet) + 1)
    bits = int(len(alphabet) + 1).bit_length()
    first = int(grp[0])
    if 3 * bits + int(grp[-1] - first + 1).bit_length() > 62:
        if grp[0] == grp[-1]:
            raise ValueError("alphabet too large for one group")
        half = np.searchsorted(groups, (grp[0] + grp[-1]) // 2, "right")
        a, b = gram_counts(texts[:half], groups[:half]), gram_counts(texts[half:], groups[half:])
        return tuple(np.concatenate(x) for x in zip(a, b))
    d = dense[cp]
    g = (grp - first) << (3 * bits)
    out = [g[letter] | d[letter] << (2 * bits)]
    if len(d) > 1:
        out.append(g[1:] | d[:-1] << (2 * bits) | d[1:] << bits)
    if len(d) > 2:
        mid = letter[1:-1]
        out.append((g[1:-1] | d[:-2] << (2 * bits) | d[1:-1] << bits | d[2:])[mid])
    if len(out) > 1:  # the space before a text is the one after the text before it
        same = grp[1:] == grp[:-1]
        out[1] = out[1][same | ~letter[:-1]]
    key = np.sort(np.concatenate(out))
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    count = np.diff(np.append(new, len(key)))
    key = key[new]
    alphabet = np.append(0, alphabet)
    low = (1 << bits) - 1
    code = alphabet[key >> (2 * bits) & low] << (2 * _BITS) | alphabet[key >> bits & low] << _BITS | alphabet[key & low]
    return (key >> (3 * bits)) + first, code, count


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``_CHARS_AT_ONCE`` characters."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= _CHARS_AT_ONCE:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def learn(training: DataFrame, text_col: str = "text", lang_col: str = "lang", profile_size: int = PROFILE_SIZE) -> Profiles:
    """Profiles of all languages in ``training``; rows with NULL language or text count nothing."""
    src = training.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = b.column(0).to_pylist()
            names = sorted(set(langs))
            number = {x: i for i, x in enumerate(names)}
            group = np.array([number[x] for x in langs], np.int64)
            for i, j in by_bytes(b.column(1), _BYTES_AT_ONCE):
                got: list[list[np.ndarray]] = [[], [], []]
                order = np.argsort(group[i:j], kind="stable")
                texts, of = b.column(1).slice(i, j - i).take(pa.array(order)).to_pylist(), group[i:j][order]
                for a, z in _blocks(texts):
                    for g, p in zip(got, gram_counts(texts[a:z], of[a:z])):
                        g.append(p)
                grp, code, n = (np.concatenate(g) if g else np.zeros(0, np.int64) for g in got)
                if len(grp):
                    at = np.lexsort((code, grp))
                    grp, code, n = grp[at], code[at], n[at]
                    new = np.flatnonzero(np.append(True, (np.diff(grp) != 0) | (np.diff(code) != 0)))
                    n = np.add.reduceat(n, new)
                    yield pa.RecordBatch.from_arrays([pa.array(names).take(pa.array(grp[new])), pa.array(code[new]), pa.array(n)], ["lang", "code", "n"])

    counts = src.mapInArrow(lean(run), "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    top = counts.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))).where(F.col("r") <= profile_size)
    rows = top.select("lang", "code", "r").collect()  # profile_size rows per language
    langs = sorted({r.lang for r in rows})
    grams = np.array(sorted({r.code for r in rows}), np.int64)
    ranks = np.full((len(grams), len(langs)), profile_size, np.int32)
    if rows:
        ranks[np.searchsorted(grams, [r.code for r in rows]), [langs.index(r.lang) for r in rows]] = [r.r - 1 for r in rows]
    return Profiles(langs, grams, ranks, profile_size)


def distances(texts: list[str | None], p: Profiles) -> tuple[np.ndarray, np.ndarray]:
    """Out-of-place sum [text, language], and how many n-grams of each text were ranked (0: no letter)."""
    total = np.zeros((len(texts), len(p.langs)), np.int64)
    used = np.zeros(len(texts), np.int64)
    for a, z in _blocks(texts):
        row, code, n = gram_counts(texts[a:z], np.arange(a, z))
        if not len(row):
            continue
        at = np.lexsort((code, -n, row))
        row, code = row[at], code[at]
        first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        rank = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
        top = rank < p.size
        row, code, rank = row[top], code[top], rank[top]
        used += np.bincount(row, minlength=len(texts))
        at = np.minimum(np.searchsorted(p.grams, code), max(len(p.grams) - 1, 0))
        for k in range(len(p.langs)):
            there = np.where(p.grams[at] == code, p.ranks[at, k], p.size)
            off = np.where(there < p.size, np.abs(there - rank), p.size)
            total[:, k] += np.bincount(row, weights=off, minlength=len(texts)).astype(np.int64)
    return total, used


def identify(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score``; columns with those names are replaced.

    ``score`` is 1 minus the winner's distance as a share of the largest possible one.
    NULL text, a text without letters, or no profile at all: ``und`` with score 0.
    Equal distances: the first language by name. Texts are read whole, in blocks.
    """

    def run(text: pa.Array) -> list[pa.Array]:
        texts = text.to_pylist()
        if not profiles.langs:
            return [pa.array([UNDETERMINED] * len(texts)), pa.array([0.0] * len(texts))]
        total, used = distances(texts, profiles)
        best = total.argmin(1)
        worst = np.maximum(used, 1) * profiles.size
        score = np.where(used > 0, 1 - total[np.arange(len(texts)), best] / worst, 0.0)
        pred = [profiles.langs[b] if u else UNDETERMINED for b, u in zip(best, used)]
        return [pa.array(pred), pa.array(score)]

    return append_columns(docs, [text_col], [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())], run, _BYTES_AT_ONCE)


def held_out():
    """The documents kept from learning: crc32 of the id's text mod 4 is 2 (NULL id: not held out)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))

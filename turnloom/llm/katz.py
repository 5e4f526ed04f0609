"""Language-model scoring by Katz backoff.

Model: n-grams up to ``order``. A count r up to ``CUTOFF`` is discounted by Good-Turing
(Katz's d_r from the counts of counts of its order), larger ones are kept. For a history
h, seen successors get d_r r / c(h); what is left goes to the others in proportion to
the next shorter history, times the backoff weight

    alpha(h) = (1 - sum over seen w of d_r r / c(h)) / (1 - sum over seen w of P(w | h'))

with both sums taken over all seen successors, so P(. | h) sums to one over the known
words, the end and one unknown word. A history without discounted counts takes one more
count (c(h) + 1) to leave something over; the shortest history leaves its rest to the
unknown word. Texts start with a start sign, which is a history but no token.

Tables (Parquet in the shared folder), all partitioned by n-gram:

1. blocks: one pass hashes the words (XXH64) and writes token numbers with a word list
   for about ``BLOCK`` tokens at a time; long texts go in pieces with their last words;
2. counts: each block sends its distinct n-grams, sorted, with their training counts, in
   one binary value for each bucket of n-grams. A bucket sums and answers in the same
   order, so only counts travel back. An n-gram occurs at most once for a block, so a
   word that makes up a third of the text is no larger a group than any other;
3. weights: for the n-grams that it is the first block to hold, a block adds discounted
   mass and lower-order probability by history; buckets of histories sum them. Orders go
   one after another, as a lower order's probabilities are needed;
4. scores: each block evaluates the recursion for each of its tokens.

The driver receives counts of counts and the totals. N-grams are told apart by 64 bits
of a hash: among 10**9 different ones two share a value with probability 0.03.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import ship_by_value
from .common import byte_views, drop_table, mix64, write_table

ship_by_value(__name__)

ORDER, CUTOFF = 2, 5
BLOCK = 1 << 20
PIECE = 1 << 20
BUCKET_TOKENS = 1 << 20
_BYTES_AT_ONCE = 1 << 20
_SPACE = re.compile(rb"[ \t-\r]")
START = np.uint64(xxhash.xxh64_intdigest(b" start"))  # no word holds a space
END = np.uint64(xxhash.xxh64_intdigest(b" end"))
_STEP = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- packed columns
def pack(a: np.ndarray) -> bytes:
    """8-byte values by byte planes, compressed: sorted keys, small counts shrink most."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, 8).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, n: int, dtype: type = np.uint64) -> np.ndarray:
    raw = pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).reshape(-1).view(dtype)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, a place of each, and each place's number among them."""
    order = np.argsort(keys)
    s = keys[order]
    new = np.append(True, s[1:] != s[:-1])[: len(s)]
    inverse = np.empty(len(s), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return s[new], order[new], inverse


# ---------------------------------------------------------------- blocks
def _word_hashes(data: bytes) -> Iterator[np.ndarray]:
    """Hashes of a text's words in order; A-Z are lower-cased."""
    at = 0
    while at < len(data):
        end = at + _BYTES_AT_ONCE
        gap = _SPACE.search(data, end) if end < len(data) else None
        end = gap.start() if gap else len(data)
        words = data[at:end].lower().split()
        yield np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        at = end


def _text_pieces(data: bytes, order: int) -> Iterator[tuple[np.ndarray, int]]:
    """``(words, how many of them are only history)``."""
    held, lead, n = [np.array([START])], 1, 0
    for h in _word_hashes(data):
        held.append(h)
        n += len(h)
        if n >= PIECE:
            whole = np.concatenate(held)
            yield whole, lead
            held, n = [whole[len(whole) - (order - 1) :]], 0
            lead = len(held[0])
    yield np.concatenate([*held, np.array([END])]), lead


def _blocks(docs: DataFrame, order: int) -> DataFrame:
    ident = docs.schema.fields[0]
    arrow_id = docs.limit(0).toArrow().schema.field(0).type
    schema = T.StructType(
        [T.StructField("block", T.LongType()), T.StructField("row", T.ArrayType(T.LongType())), T.StructField("id", T.ArrayType(ident.dataType)),
         T.StructField("train", T.ArrayType(T.BooleanType())), T.StructField("first", T.ArrayType(T.BooleanType())),
         T.StructField("size", T.ArrayType(T.IntegerType())), T.StructField("lead", T.ArrayType(T.IntegerType())),
         T.StructField("n_slots", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("words", T.BinaryType()), T.StructField("slots", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rows, blocks, held = 0, 0, []  # held: (row, id, train, first, lead, words)

        def flush() -> pa.RecordBatch:
            h = np.concatenate([x[5] for x in held])
            words, _, number = distinct(h)
            by_count = np.argsort(-np.bincount(number, minlength=len(words)), kind="stable")  # frequent words: small numbers
            place = np.empty_like(by_count)
            place[by_count] = np.arange(len(words))
            row, ids, train, first, lead, part_words = zip(*held)
            cols = [
                pa.array([part << 32 | blocks], pa.int64()), pa.array([row], pa.list_(pa.int64())), pa.array([list(ids)], pa.list_(arrow_id)),
                pa.array([train], pa.list_(pa.bool_())), pa.array([first], pa.list_(pa.bool_())),
                pa.array([[len(w) for w in part_words]], pa.list_(pa.int32())), pa.array([lead], pa.list_(pa.int32())),
                pa.array([len(h)], pa.int64()), pa.array([len(words)], pa.int64()),
                pa.array([pack(words[by_count])], pa.binary()), pa.array([pack(place[number])], pa.binary()),
            ]
            held.clear()
            return pa.RecordBatch.from_arrays(cols, schema.names)

        n = 0
        for b in batches:
            for i, train, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), byte_views(b.column(2))):
                for k, (words, lead) in enumerate(_text_pieces(data, order)):
                    held.append((part << 40 | rows, i, bool(train), k == 0, lead, words))
                    n += len(words)
                    if n >= BLOCK:
                        yield flush()
                        blocks, n = blocks + 1, 0
                rows += 1
        if held:
            yield flush()

    return docs.mapInArrow(run, schema)


@dataclass
class Grams:
    """The n-grams of a block: for each order the sorted distinct keys, a place of each and
    every slot's number (-1: the n-gram would reach over the start)."""

    row: list
    ids: list
    owner: np.ndarray
    trained: np.ndarray
    token: np.ndarray
    keys: list[np.ndarray]
    at: list[np.ndarray]
    number: list[np.ndarray]

    def counts(self, o: int) -> np.ndarray:
        """Training counts of the distinct n-grams of order ``o + 1``."""
        on = self.trained & (self.number[o] >= 0)
        return np.bincount(self.number[o][on], minlength=len(self.keys[o])).astype(np.uint64)


def _grams(b: dict, order: int) -> Grams:
    words = unpack(b["words"], b["n_words"])
    h = words[unpack(b["slots"], b["n_slots"], np.int64)]
    size, lead = np.array(b["size"], np.int64), np.array(b["lead"], np.int64)
    begin = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(h)) - begin[owner]
    token = place >= lead[owner]
    opens = np.zeros(len(h), bool)
    opens[begin[np.array(b["first"], bool)]] = True  # the start sign, counted as a history
    trained = np.array(b["train"], bool)[owner] & (token | opens)
    keys, ats, numbers = [], [], []
    key = None
    for o in range(order):
        if o == 0:
            key = mix64(h * _STEP)
        else:
            longer = mix64(key[:-1] * _STEP + h[1:])
            key = np.concatenate([key[:1], longer])
        slots = np.flatnonzero(place >= o)
        u, at, inverse = distinct(key[slots])
        number = np.full(len(h), -1, np.int64)
        number[slots] = inverse
        keys.append(u)
        ats.append(slots[at])
        numbers.append(number)
    return Grams(b["row"], b["id"], owner, trained, token, keys, ats, numbers)


def _cut(keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """``(bucket, from, to)`` of the sorted keys: a bucket is the upper bits."""
    if not len(keys):
        return []
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    return list(zip(bucket[edge].tolist(), edge.tolist(), np.append(edge[1:], len(keys)).tolist()))


# ---------------------------------------------------------------- counts
_SENT = "o int, bucket int, block long, n long, keys binary, a binary, b binary"
_REPLY = "kind int, o int, bucket int, block long, n long, a binary, b binary, stats array<long>"
_NONE = np.zeros(0)


def _table(rows: list[dict], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [x.strip().split(" ") for x in schema.split(",")]
    return pa.Table.from_pylist(rows, pa.schema([(n, kinds[t]) for n, t in fields]))


def _message(o: int, bits: int, block: int, keys: np.ndarray, a: np.ndarray, b: np.ndarray | None) -> Iterator[dict]:
    for bucket, i, j in _cut(keys, bits):
        yield {"o": o, "bucket": bucket, "block": block, "n": j - i, "keys": pack(keys[i:j]), "a": pack(a[i:j]), "b": None if b is None else pack(b[i:j])}


def _meet(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """All keys of a bucket: distinct number of each entry, the keys, and where blocks end."""
    keys = np.concatenate([unpack(r["keys"], r["n"]) for r in rows])
    u, _, number = distinct(keys)
    return number, u, np.cumsum([r["n"] for r in rows]).tolist()


def _sum_counts(cutoff: int):
    start = mix64(np.array([START]) * _STEP)[0]

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["block"])
        number, u, ends = _meet(rows)
        c = np.concatenate([unpack(r["a"], r["n"]) for r in rows])
        total = np.bincount(number, weights=c, minlength=len(u)).astype(np.int64)
        here = np.flatnonzero(c > 0)
        owner = np.zeros(len(c), np.int64)
        owner[here[np.unique(number[here], return_index=True)[1]] if len(here) else here] = 1
        out, i = [], 0
        o, bucket = rows[0]["o"], rows[0]["bucket"]
        for r, j in zip(rows, ends):
            out.append({"kind": 0, "o": o, "bucket": bucket, "block": r["block"], "n": j - i, "a": pack(total[number[i:j]]), "b": pack(owner[i:j]), "stats": None})
            i = j
        seen = total[(total > 0) & (u != start)] if o == 0 else total[total > 0]
        by_count = np.bincount(np.minimum(seen, cutoff + 2), minlength=cutoff + 3)
        stats = [int(seen.sum()), len(seen), *by_count[1 : cutoff + 2].tolist()]
        out.append({"kind": 1, "o": o, "bucket": bucket, "block": -1, "n": 0, "a": b"", "b": b"", "stats": stats})
        return _table(out, _REPLY)

    return run


def good_turing(by_count: list[int], cutoff: int) -> np.ndarray:
    """d_0 .. d_(cutoff + 1); the last one, 1, is that of all larger counts. ``by_count[r - 1]``
    n-grams have count r. Where Katz's formula gives no value in (0, 1) for each count up to
    the cutoff, the cutoff falls; below 2 every count gives half an occurrence away."""
    for k in range(cutoff, 1, -1):
        n = by_count[: k + 1]
        if min(n) <= 0:
            continue
        common = (k + 1) * n[k] / n[0]
        if common >= 1:
            continue
        d = [((r + 1) * n[r] / n[r - 1] / r - common) / (1 - common) for r in range(1, k + 1)]
        if all(0 < x < 1 for x in d):
            return np.array([0.0, *d] + [1.0] * (cutoff + 1 - k))
    return np.array([0.0] + [(r - 0.5) / r for r in range(1, cutoff + 1)] + [1.0])


@dataclass(frozen=True)
class Model:
    order: int
    cutoff: int
    tokens: int
    known: int
    discount: list[np.ndarray]
    divisor: float  # of the shortest history
    unknown: float

    def part(self, o: int, count: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        return self.discount[o][np.minimum(count, self.cutoff + 1)] * count

    def shortest(self, count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, self.part(0, count) / self.divisor, self.unknown)


def _model(stats: list, order: int, cutoff: int) -> Model:
    total = np.zeros((order, cutoff + 3), object)
    for r in stats:
        total[r.o] += np.array(r.stats, object)
    discount = [good_turing([int(v) for v in total[o][2:]], cutoff) for o in range(order)]
    tokens, known = int(total[0][0]), int(total[0][1])
    lost = sum((1 - discount[0][r]) * r * int(total[0][1 + r]) for r in range(1, cutoff + 1))
    divisor = tokens if lost > 0 else tokens + 1
    return Model(order, cutoff, tokens, known, discount, float(divisor), (lost if lost > 0 else 1.0) / divisor)


class _Replies:
    """What the buckets answered to one block, by order, in the order of its keys."""

    def __init__(self, table: pa.Table):
        rows = sorted(table.to_pylist(), key=lambda r: (r["kind"], r["o"], r["bucket"]))
        self.rows = {(k, o): [r for r in rows if (r["kind"], r["o"]) == (k, o)] for k, o in {(r["kind"], r["o"]) for r in rows}}

    def get(self, kind: int, o: int, col: str, dtype: type) -> np.ndarray:
        return np.concatenate([unpack(r[col], r["n"], dtype) for r in self.rows.get((kind, o), [])] or [_NONE.astype(dtype)])


def _probabilities(g: Grams, replies: _Replies, m: Model, upto: int) -> np.ndarray:
    """P of each slot given at most ``upto - 1`` words before it."""
    count = replies.get(0, 0, "a", np.int64)
    p = m.shortest(count)[g.number[0]]
    for o in range(1, upto):
        history, count = count, replies.get(0, o, "a", np.int64)
        weight = replies.get(2, o, "a", np.float64)
        i = np.flatnonzero(g.number[o] >= 0)
        h, r = g.number[o - 1][i - 1], count[g.number[o][i]]
        divisor = history[h] + (weight[h] < 0)  # below zero: no discounted count
        known = history[h] > 0
        i, h, r, divisor = i[known], h[known], r[known], divisor[known]
        p[i] = np.where(r > 0, m.part(o, r) / divisor, np.abs(weight[h]) / divisor * p[i])
    return p


# ---------------------------------------------------------------- weights and scores
def _send_weights(order: int, o: int, bits: int, m: Model):
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        out: list[dict] = []
        for b in block.to_pylist():
            g, replies = _grams(b, order), _Replies(answers)
            lower = _probabilities(g, replies, m, o)
            mine = replies.get(0, o, "b", np.int64) > 0
            at, r = g.at[o][mine], replies.get(0, o, "a", np.int64)[mine]
            h, n = g.number[o - 1][at - 1], len(g.keys[o - 1])
            lost = np.bincount(h, weights=r - m.part(o, r), minlength=n)
            out += _message(o, bits, b["block"], g.keys[o - 1], lost, np.bincount(h, weights=lower[at], minlength=n))
        return _table(out, _SENT)

    return run


def _sum_weights(group: pa.Table) -> pa.Table:
    rows = sorted(group.to_pylist(), key=lambda r: r["block"])
    number, u, ends = _meet(rows)
    lost, low = (np.bincount(number, weights=np.concatenate([unpack(r[c], r["n"], np.float64) for r in rows]), minlength=len(u)) for c in ("a", "b"))
    # Of a history with discounted counts: its weight times c(h); of another: minus that.
    weight = np.where(lost > 0, lost, -1.0) / np.maximum(1 - low, np.finfo(float).tiny)
    out, i = [], 0
    for r, j in zip(rows, ends):
        out.append({"kind": 2, "o": r["o"], "bucket": r["bucket"], "block": r["block"], "n": j - i, "a": pack(weight[number[i:j]]), "b": b"", "stats": None})
        i = j
    return _table(out, _REPLY)


def _score_block(order: int, m: Model, schema: T.StructType, arrow_id: pa.DataType):
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        parts = []
        for b in block.to_pylist():
            g, replies = _grams(b, order), _Replies(answers)
            t, n = g.token, len(g.row)
            owner, c = g.owner[t], replies.get(0, 0, "a", np.int64)[g.number[0][t]]
            base = np.log10((c + 0.1) / (m.tokens + 0.1 * (m.known + 1)))
            logp = np.log10(_probabilities(g, replies, m, order)[t])
            cols = [
                pa.array(g.row, pa.int64()), pa.array(g.ids, arrow_id), pa.array(b["train"], pa.bool_()), pa.array(np.bincount(owner, minlength=n)),
                pa.array(np.bincount(owner[c > 0], minlength=n)), pa.array(np.bincount(owner, weights=base, minlength=n)), pa.array(np.bincount(owner, weights=logp, minlength=n)),
            ]
            parts.append(pa.Table.from_arrays(cols, schema.names))
        return pa.concat_tables(parts) if parts else pa.table({f: pa.array([], t) for f, t in zip(schema.names, [pa.int64(), arrow_id, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()])})

    return run


def katz_scores(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, cutoff: int = CUTOFF) -> DataFrame:
    """``(id, trained, n_tokens, n_known, train_tokens, train_words, base_score, score)`` for
    every row of ``docs``; the model learns from the rows where ``training`` holds (NULL: not).

    Tokens are the words of the whole text (A-Z lower-cased, cut at space and \\t..\\r) and
    one end. ``base_score``: log10 of the product of (c + 0.1) / (N + 0.1 (V + 1));
    ``score``: log10 of the product of the Katz probabilities. NULL or empty text: the end
    alone. Repeated rows and ids are scored, and counted, as often as they stand there; a
    NULL id stays NULL. Without training rows every token is the unknown word, of
    probability 1. Only the id, the text and what ``training`` names are read. An empty
    table gives no rows. A very long text is scored in pieces that know the words before.
    """
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(training, F.lit(False)).alias("train"), F.col(text_col).alias("text"))
    ident = src.schema.fields[0]
    arrow_id = src.limit(0).toArrow().schema.field(0).type
    blocks = write_table(_blocks(src, order), "katz-blocks")
    slots = blocks.agg(F.sum("n_slots")).first()[0] or 0
    bits = max(0, int(slots // BUCKET_TOKENS).bit_length())

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                g = _grams(b, order)
                for o in range(order):
                    yield from _table(list(_message(o, bits, b["block"], g.keys[o], g.counts(o), None)), _SENT).to_batches()

    counts = blocks.mapInArrow(send, _SENT).groupBy("o", "bucket").applyInArrow(_sum_counts(cutoff), _REPLY)
    replies = write_table(counts, "katz-counts")
    m = _model(replies.where("kind = 1").select("o", "stats").collect(), order, cutoff)
    answers = replies.where("kind <> 1")
    tables = [blocks, replies]
    for o in range(1, order):
        sent = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_send_weights(order, o, bits, m), _SENT)
        weights = write_table(sent.groupBy("o", "bucket").applyInArrow(_sum_weights, _REPLY), "katz-weights")
        answers = answers.unionByName(weights)
        tables.append(weights)
    schema = T.StructType(
        [T.StructField("row", T.LongType()), T.StructField("id", ident.dataType), T.StructField("train", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
         T.StructField("n_known", T.LongType()), T.StructField("base", T.DoubleType()), T.StructField("logp", T.DoubleType())]
    )
    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score_block(order, m, schema, arrow_id), schema)
    pieces = scored.groupBy("row").agg(
        F.first("id").alias(id_col), F.first("train").alias("trained"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.lit(m.tokens).cast("long").alias("train_tokens"), F.lit(m.known).cast("long").alias("train_words"), F.sum("base").alias("base_score"), F.sum("logp").alias("score"),
    )
    out = write_table(pieces.drop("row"), "katz-scores")
    for t in tables:
        drop_table(t)
    return out


def held_out(id_col: str = "doc_id") -> Column:
    """The documents kept from learning: crc32 of the id's text mod 10 is 0 (NULL id: not held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 10 == 0, F.lit(False))

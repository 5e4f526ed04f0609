"""SentencePiece encoding and decoding over a relational lattice.

A text is normalised as the model says (a space becomes U+2581, one is put in front) and
cut wherever no piece holds the two neighbouring characters side by side: no piece can
cross such a place, so the best path of the text is the best paths of its parts. The
distinct parts of the corpus are the words of the lattice: each is exploded to its
substrings of at most the longest piece's length, equi-joined to the piece table
(broadcast; its size is the model's), the edges are grouped by word, and a higher-order
``aggregate`` folds Viterbi over them, then the path back. The scores of such a model are
merge ranks and no log-probabilities, so a path is judged by its number of pieces first
and by the sum of its pieces' ranks second. A character without a piece gets an edge
ranked below all pieces and is spelled in byte pieces.

A part longer than ``MAX_UNIT`` characters (a row of one character, or of spaces) is
also cut behind every ``MAX_UNIT`` characters. All parts take the lattice, whatever
their length.

Parts meet the documents again by blocks of neighbouring documents: each sends its
distinct parts, with the block's number, to the lattice and gets a dictionary of the
block back, packed by the lattice's tasks and opened piece by piece; texts are shuffled once, to it, as compressed Arrow batches. Nothing is
broadcast but the piece table.
Long texts have blocks of their own by size, so a block holds a few ``block_bytes`` or
one text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import ship_by_value
from .common import append_columns, by_bytes, give_back, lean, write_table

ship_by_value(__name__)

SPACE = "▁"
MAX_UNIT = 240  # at most 255: a place has 8 bits in an edge
BLOCK_BYTES = 32 << 20
TASK_BYTES = 6 << 20  # text for each task of the lattice
ORDINARY = 32  # times the mean size; longer texts have blocks by size
CUT_BYTES = 1 << 18  # text cut at once
BATCH_BYTES = 2 << 20  # text packed and coded at once
SEEN = 1_000_000  # parts a task keeps before it sends their distinct ones
REPLY = 400_000  # paths a task keeps before it sends them to their blocks
OPENED = 100_000  # paths opened at once
DECODED = 1_000_000  # ids decoded at once
DECODED_BYTES = 4 << 20  # of rows decoded at once


@dataclass(frozen=True)
class Pieces:
    """The model's normal pieces with ranks (0 is best), and its byte pieces."""

    ids: dict[str, tuple[int, int]]
    bytes_: list[int]  # id of each byte's piece
    spelled: list[bytes]  # what each id decodes to
    longest: int
    unk: int  # rank of a character without a piece

    @staticmethod
    def load(path: str) -> Pieces:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids, bytes_, spelled = {}, [0] * 256, []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                bytes_[int(piece[1:-1], 16)] = i
                spelled.append(bytes([int(piece[1:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                spelled.append(b"")
            else:
                ids[piece] = i
                spelled.append(piece.replace(SPACE, " ").encode())
        if len(spelled) >= _NO_PIECE:
            raise ValueError("more pieces than an edge can name")
        order = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in ids.values()}, reverse=True))}
        ranked = {p: (i, order[sp.get_score(i)]) for p, i in ids.items()}
        return Pieces(ranked, bytes_, spelled, max(map(len, ids)), len(order))

    def table(self, spark: SparkSession) -> DataFrame:
        """``(piece, code)``: the rank and the id, where an edge has them."""
        rows = [(p, rank << 26 | i) for p, (i, rank) in self.ids.items()]
        return spark.createDataFrame(rows, "piece string, code long")


# ---------------------------------------------------------------- parts
@dataclass(frozen=True)
class Pairs:
    """Which two characters stand side by side in a piece."""

    kind: np.ndarray  # of each code point; 0: in no piece
    bits: np.ndarray  # bit kind(a) * n + kind(b)
    n: int

    @staticmethod
    def of(pieces: list[str]) -> Pairs:
        chars = sorted({c for p in pieces for c in p})
        n = len(chars) + 1
        at = {c: i for i, c in enumerate(chars, 1)}
        kind = np.zeros(0x110000, np.int32)
        kind[[ord(c) for c in chars]] = np.arange(1, n)
        bits = np.zeros(n * n // 8 + 1, np.uint8)
        keys = np.array([at[a] * n + at[b] for a, b in {x for p in pieces for x in zip(p, p[1:])}], np.int64)
        np.bitwise_or.at(bits, keys >> 3, np.left_shift(1, keys & 7).astype(np.uint8))
        return Pairs(kind, bits, n)

    def apart(self, before: int, kinds: np.ndarray) -> np.ndarray:
        """For each character, whether no piece holds it right after the one before."""
        key = np.concatenate(([before], kinds[:-1])).astype(np.int64) * self.n + kinds
        return (self.bits[key >> 3] >> (key & 7).astype(np.uint8)) & 1 == 0


def parts(texts: pa.Array, pairs: Pairs) -> tuple[pa.Array, np.ndarray]:
    """All parts of the normalised texts, in order, and where each text's begin (one more
    at the end). NULL and empty texts have none."""
    col = pc.fill_null(texts.cast(pa.large_string()), "")
    some = pc.not_equal(col, "")
    col = pc.replace_substring(col, " ", SPACE)
    col = pc.if_else(some, pc.binary_join_element_wise(pa.scalar(SPACE, pa.large_string()), col, pa.scalar("", pa.large_string())), "")
    rows = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    data = np.frombuffer(col.buffers()[2], np.uint8, int(rows[-1] - rows[0]), int(rows[0])) if rows[-1] > rows[0] else np.zeros(0, np.uint8)
    rows = rows - rows[0]
    begins, at, before = np.zeros(len(data) + 1, bool), 0, 0
    begins[rows] = True
    while at < len(data):
        end = min(at + CUT_BYTES, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        raw = data[at:end]
        code = np.frombuffer(raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = pairs.kind[code]
        begins[at + np.flatnonzero((raw & 0xC0) != 0x80)[pairs.apart(before, kinds)]] = True
        at, before = end, int(kinds[-1])
    cut = np.flatnonzero(begins)
    more = []
    for i in np.flatnonzero(np.diff(cut) > MAX_UNIT).tolist():
        chars = np.flatnonzero((data[cut[i] : cut[i + 1]] & 0xC0) != 0x80)
        more.append(cut[i] + chars[MAX_UNIT::MAX_UNIT])
    if more:
        cut = np.unique(np.concatenate([cut, *more]))
    if not len(data):
        return pa.array([], pa.large_string()), np.zeros(len(rows), np.int64)
    found = pa.LargeStringArray.from_buffers(len(cut) - 1, pa.py_buffer(np.ascontiguousarray(cut, np.int64)), pa.py_buffer(data))
    return found, np.searchsorted(cut, rows)


# ---------------------------------------------------------------- the lattice
# An edge is one long: end (8 bits from 52), rank (26 bits from 26), start (8 bits from
# 18), id (18 bits). The best edge into a place has the path's number of pieces instead
# of the end and the sum of ranks instead of the rank, so that the smallest long is the
# best one: fewest pieces, best ranks, then the last piece that starts first.
_NO_PIECE = (1 << 18) - 1
_FOLD = """
aggregate(array_sort(edges), array(0L),
  (a, x) -> concat(slice(a, 1, CAST(shiftright(x, 52) AS INT)), array(least(
    (get(a, CAST(shiftright(x, 18) & 255L AS INT)) & -67108864L) + (x & 4503599627370495L) + 4503599627370496L,
    get(a, CAST(shiftright(x, 52) AS INT))))))
"""
_BACK = """
aggregate(slice(sequence(1, CAST(shiftright(element_at(best, -1), 52) AS INT)), 2, 255), array(element_at(best, -1)),
  (a, k) -> concat(array(get(best, CAST(shiftright(a[0], 18) & 255L AS INT))), a),
  a -> transform(a, x -> CAST((shiftright(x, 18) & 255L) - 128 AS TINYINT)))
"""


def edges(words: DataFrame, p: Pieces) -> DataFrame:
    """``words`` with ``edge``: every piece in every word, and a character without one.
    Other columns of ``words`` stay with the word's first character alone."""
    keep = [c for c in words.columns if c != "word"]
    spans = words.select("*", F.explode(F.expr("sequence(0, length(word) - 1)")).alias("s"))
    spans = spans.select("*", F.explode(F.expr(f"sequence(1, least({p.longest}, length(word) - s))")).alias("l"))
    first = [F.when(F.expr("s = 0 AND l = 1"), F.col(c)).alias(c) for c in keep]
    subs = spans.select("word", *first, "s", "l", F.expr("substring(word, s + 1, l)").alias("piece"))
    found = subs.join(F.broadcast(p.table(words.sparkSession)), "piece", "left").where("code IS NOT NULL OR l = 1")
    code = F.coalesce("code", F.lit(p.unk << 26 | _NO_PIECE))
    end, start = F.shiftleft((F.col("s") + F.col("l")).cast("long"), 52), F.shiftleft(F.col("s").cast("long"), 18)
    return found.select("word", *keep, end.bitwiseOR(start).bitwiseOR(code).alias("edge"))


def best_paths(words: DataFrame, p: Pieces) -> DataFrame:
    """Distinct ``words (word, ...)`` with ``starts``, where the path's pieces start (less 128, so
    that a byte holds it). Words are dealt by word: exploding and
    joining leave them in place, so grouping the edges does not shuffle."""
    keep = [c for c in words.columns if c != "word"]
    grouped = edges(words, p).groupBy("word").agg(F.collect_list("edge").alias("edges"), *[F.first(c, True).alias(c) for c in keep])
    return grouped.select("word", *keep, F.expr(_FOLD).alias("best")).select("word", *keep, F.expr(_BACK).alias("starts"))


def _packed(words: pa.Array, paths: pa.Array) -> bytes:
    """Words and where their paths' pieces start, small: how many words and how many bytes of
    them; each word's bytes and pieces, the words, the starts."""
    rows = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, words.offset * 8)
    pieces = paths.offsets.to_numpy()
    values = paths.values.slice(int(pieces[0]), int(pieces[-1] - pieces[0])).to_numpy()
    text = words.buffers()[2].slice(int(rows[0]), int(rows[-1] - rows[0]))
    head = np.array([len(words), len(text), len(values)], np.int64).tobytes()
    body = b"".join([np.diff(rows).astype(np.uint16).tobytes(), np.diff(pieces).astype(np.uint8).tobytes(), text.to_pybytes(), values.tobytes()])
    return head + pa.compress(body, codec="zstd", asbytes=True)


def _unpacked(rows: Iterable[pa.Scalar]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """What ``_packed`` has packed: words, the places of their starts and the starts, ``OPENED``
    words or more at once."""
    size, n, text, starts, held = [], [], [], [], 0
    for row in rows:
        raw = row.as_buffer()
        words, length, places = np.frombuffer(raw, np.int64, 3).tolist()
        body = np.frombuffer(pa.decompress(raw.slice(24), 3 * words + length + places, codec="zstd"), np.uint8)
        for part, piece in zip((size, n, text, starts), np.split(body, np.cumsum([2 * words, words, length]))):
            part.append(piece)
        held += words
        if held > OPENED:
            yield _side_by_side(size, n, text, starts)
            size, n, text, starts, held = [], [], [], [], 0
    if held:
        yield _side_by_side(size, n, text, starts)


def _side_by_side(size: list, n: list, text: list, starts: list) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    at = np.append(0, np.cumsum(np.concatenate(size).view(np.uint16), dtype=np.int64))
    words = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(np.concatenate(text)))
    return words, np.append(0, np.cumsum(np.concatenate(n), dtype=np.int64)), np.concatenate(starts).view(np.int8).astype(np.int64) + 128


def _ids_of_paths(words: pa.Array, of_word: np.ndarray, start: np.ndarray, pieces: pa.Array, ids: np.ndarray, byte_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words, one after the other, and each word's number. Its pieces begin
    at the places ``start[of_word[i]:of_word[i + 1]]``; a character without a piece is
    spelled in byte pieces."""
    rows = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, words.offset * 8)
    data = np.frombuffer(words.buffers()[2], np.uint8, int(rows[-1] - rows[0]), int(rows[0]))
    chars = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(chars, rows[:-1] - rows[0])
    cut = np.append(chars[np.repeat(first, np.diff(of_word)) + start], len(data))
    found = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(cut), pa.py_buffer(data))
    which = pc.fill_null(pc.index_in(found, value_set=pieces), -1).to_numpy(zero_copy_only=False)
    size = np.where(which < 0, np.diff(cut), 1)
    ends = np.append(0, np.cumsum(size))
    flat = np.repeat(ids[which], size)
    odd = np.repeat(which < 0, size)
    inside = np.arange(len(flat)) - np.repeat(ends[:-1], size)
    flat[odd] = byte_ids[data[(np.repeat(cut[:-1], size) + inside)[odd]]]
    return flat.astype(np.int32), np.diff(ends[of_word])


# ---------------------------------------------------------------- documents
def _in_blocks(src: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """``src`` with ``block``, and the bytes of its texts: neighbouring rows of an input
    file share a block, however the file is split; texts of ``ORDINARY`` times the mean size
    and more share one with texts of their size. As many rows as no text can make too large
    are a block at least; a block is as many of these as are never over ``block_bytes`` in
    this table, so that it has one dictionary for all the text it can hold. Rows of no file
    are written to one first."""
    try:
        src.select("_metadata.row_index").schema
    except AnalysisException:
        src = write_table(src, "pieces-docs")
    size = F.octet_length("text")
    total = src.agg(F.sum(size).alias("b"), F.count(F.lit(1)).alias("n")).first()
    mean = max(1, (total["b"] or 0) // max(total["n"], 1))
    kind = F.when(size < ORDINARY * mean, F.lit(0)).otherwise(F.length(F.bin(size.cast("long")))).cast("int")
    rows = F.when(kind == 0, F.lit(max(1, block_bytes // (ORDINARY * mean)))).otherwise(F.greatest(F.lit(1), F.expr(f"shiftright({block_bytes}L, length(bin(CAST(octet_length(text) AS BIGINT))))")))
    file, least = F.col("_metadata.file_path"), F.floor(F.col("_metadata.row_index") / rows)
    held = src.groupBy(file.alias("f"), kind.alias("kind"), least.alias("i")).agg(F.sum(size).alias("b"))
    steps = sorted({m << k for m in (2, 3) for k in range(16)})
    merged = held.select("f", "kind", "b", "i", F.explode(F.array(*map(F.lit, steps))).alias("n")).groupBy("f", "kind", "n", F.floor(F.col("i") / F.col("n"))).agg(F.sum("b").alias("b"))
    fit = merged.groupBy("kind", "n").agg(F.max("b").alias("b")).where(F.col("b") <= block_bytes).groupBy("kind").agg(F.max("n").alias("n")).collect()  # a row for each kind
    many = F.lit(1)
    for r in fit:
        many = F.when(kind == r["kind"], F.lit(r["n"])).otherwise(many)
    return src.select(F.hash(file, kind, F.floor(least / many)).alias("block"), *src.columns), total["b"] or 0


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``id_col``, the ``carry`` columns, ``n_tokens`` and ``ids``.

    NULL and empty texts have no ids; repeated rows and repeated or NULL ids keep their
    rows; an empty table gives an empty result. U+2581 in a text counts as a space.
    """
    carry = carry or []
    spark = docs.sparkSession
    p = Pieces.load(model_path)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).alias("id"), *[F.col(c).alias(f"c_{c}") for c in carry], text.alias("text"))
    src, size = _in_blocks(src, block_bytes)
    shared = spark.sparkContext.broadcast((list(p.ids), [i for i, _ in p.ids.values()], p.bytes_))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = Pairs.of(shared.value[0])
        seen: dict[int, list[pa.Array]] = {}
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            while seen:
                k, found = seen.popitem()
                got = pa.chunked_array(found).unique()
                del found
                got = got.cast(pa.string()).sort()  # neighbours alike: a smaller shuffle
                for a in range(0, len(got), 50_000):
                    w = got.slice(a, 50_000)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(w), k, np.int32)), w], ["block", "word"])

        for batch in batches:
            keys, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            for a, b in by_bytes(texts, BATCH_BYTES):
                found, first = parts(texts.slice(a, b - a), pairs)
                cut = np.flatnonzero(np.diff(keys[a:b])) + 1
                for i, j in zip(np.append(0, cut).tolist(), np.append(cut, b - a).tolist()):
                    got = found.slice(first[i], first[j] - first[i]).unique()
                    if len(got):
                        seen.setdefault(int(keys[a + i]), []).append(got)
                        held += len(got)
                if held > SEEN:
                    yield from out()
                    held = 0
        yield from out()

    tasks = max(1, -(-size // TASK_BYTES))
    used = src.select("block", "text").mapInArrow(lean(words), "block int, word string")
    used = used.repartition(tasks, "word").groupBy("word").agg(F.collect_set("block").alias("blocks"))
    lookup = best_paths(used, p).select(F.explode("blocks").alias("block"), "word", "starts")

    kinds = {f.name: f for f in src.schema.fields}
    kept = [kinds["id"]] + [kinds[f"c_{c}"] for c in carry]
    schema = T.StructType([*kept, T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    names = [f.name for f in kept]

    def stream(batch: pa.RecordBatch) -> bytes:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=5))) as w:
            w.write_batch(batch)
        return sink.getvalue().to_pybytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = np.argsort(batch.column(0).to_numpy(zero_copy_only=False), kind="stable")
            batch = batch.take(pa.array(order))
            keys, rest = batch.column(0).to_numpy(zero_copy_only=False), batch.select(batch.schema.names[1:])
            cut = np.flatnonzero(np.diff(keys)) + 1
            for i, j in zip(np.append(0, cut).tolist(), np.append(cut, len(keys)).tolist() if len(keys) else []):
                for a, b in by_bytes(rest.column("text").slice(i, j - i), BATCH_BYTES):
                    yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + 1]), pa.array([stream(rest.slice(i + a, b - a))], pa.binary())], ["block", "rows"])

    def reply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks()
            rows = rows.take(pc.sort_indices(rows["block"]))
            keys = rows["block"].to_numpy()
            cut = np.flatnonzero(np.diff(keys)) + 1
            word, starts = rows["word"].combine_chunks().cast(pa.large_string()), rows["starts"].combine_chunks()
            held.clear()
            for i, j in zip(np.append(0, cut).tolist(), np.append(cut, len(keys)).tolist()):
                yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + 1]), pa.array([_packed(word.slice(i, j - i), starts.slice(i, j - i))], pa.binary())], ["block", "rows"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) > REPLY:
                yield from out()
        if held:
            yield from out()

    def fill(docs_: pa.Table, lookup_: pa.Table) -> pa.Table:
        pairs = Pairs.of(shared.value[0])
        pieces, ids_of, byte_ids = pa.array(shared.value[0], pa.large_string()), np.array(shared.value[1]), np.array(shared.value[2])
        words, flats, sizes = [pa.array([], pa.large_string())], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for known, of_word, start in _unpacked(lookup_.column("rows")):
            flat, size = _ids_of_paths(known, of_word, start, pieces, ids_of, byte_ids)
            words.append(known), flats.append(flat), sizes.append(size)
        known, flat, size = pa.concat_arrays(words), np.concatenate(flats), np.concatenate(sizes)
        at = np.append(0, np.cumsum(size))
        del words, flats, sizes
        coded = []
        for packed in docs_.column("rows"):
            rows = pa.ipc.open_stream(packed.as_buffer()).read_next_batch()
            found, first = parts(rows.column("text"), pairs)
            coded.append((rows.select(names), found.dictionary_encode(), first))
        where = pc.index_in(pa.chunked_array([c[1].dictionary for c in coded], pa.large_string()), value_set=known).combine_chunks().to_numpy(zero_copy_only=False)
        del known
        batches, done = [], 0
        for rows, found, first in coded:
            which = where[done : done + len(found.dictionary)][found.indices.to_numpy()]
            done += len(found.dictionary)
            n = size[which]
            ends = np.append(0, np.cumsum(n))
            ids = flat[np.repeat(at[which] - ends[:-1], n) + np.arange(ends[-1])].astype(np.int32)
            cut = ends[first]
            batches.append(pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.diff(cut)), pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(ids))], [*names, "n_tokens", "ids"]))
        del flat, where, coded, rows, found, which, n, ends, ids
        give_back()
        return pa.Table.from_batches(batches)

    src = src.mapInArrow(lean(pack), "block int, rows binary")
    lookup = lookup.mapInArrow(lean(reply), "block int, rows binary")
    got = src.groupBy("block").cogroup(lookup.groupBy("block")).applyInArrow(fill, schema)
    return got.select(F.col("id").alias(id_col), *[F.col(f"c_{c}").alias(c) for c in carry], "n_tokens", "ids")


def decode(rows: DataFrame, model_path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` plus the text of the ids: pieces side by side, U+2581 to a space, byte
    pieces to their bytes, without the first space. NULL ids: empty text. A byte sequence
    that is not UTF-8 becomes U+FFFD."""
    spelled = rows.sparkSession.sparkContext.broadcast(Pieces.load(model_path).spelled)

    def run(col: pa.Array) -> list[pa.Array]:
        table, cut, texts, i = pa.array(spelled.value, pa.large_binary()), col.offsets.to_numpy(), [], 0
        while i < len(col):  # as many rows as hold so many ids; one more than that stands alone
            j = max(i + 1, int(np.searchsorted(cut, cut[i] + DECODED, "right")) - 1)
            pieces = table.take(col.values.slice(cut[i], cut[j] - cut[i]))
            at = np.frombuffer(pieces.buffers()[1], np.int64, len(pieces) + 1, pieces.offset * 8)[cut[i : j + 1] - cut[i]].tolist()
            data = pieces.buffers()[2]
            some = []
            for a, b in zip(at, at[1:]):  # a text's pieces stand side by side in the buffer
                raw = data.slice(a, b - a).to_pybytes() if b > a else b""
                some.append((raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace"))
            texts.append(pa.array(some, pa.string()))
            i = j
        return [pa.concat_arrays(texts)]

    return append_columns(rows, [ids_col], [T.StructField(out, T.StringType())], run, DECODED_BYTES)

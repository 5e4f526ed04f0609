"""Token ids in files: static range asymmetric numeral system (rANS).

One frequency table, counted over all ids and scaled to ``2**SCALE_BITS``, is shared by
all blocks. A block holds ``BLOCK`` ids that are dealt over ``LANES`` interleaved 64-bit
states (id i belongs to lane i mod LANES), so one numpy step codes an id of every lane,
and of many blocks at once. Blocks do not depend on each other; in a block, checkpoints
(all states, and the place in the word stream) allow decoding to start in the middle,
and a CRC-32 of the ids guards each block.

File format: a segment is one row ``(part, seg, first, n, doc_id[], n_tokens[], data)``
of a Parquet dataset in the shared folder, so that any store Spark writes to will do and
a lost task is written anew; ``data`` is the concatenation of the segment's blocks:

    b"TLR1", u32 ids, u32 lanes, u32 checkpoint steps, u32 words, u32 crc32(ids as u32le),
    u64 states[checkpoints][lanes], u32 word offset[checkpoints], u32 words

all little-endian. A document's ids never cross a segment; segments follow the order of
the document ids: ``part`` is the place of the range partition, ``seg`` the place in it,
``first`` the ids of the partition that come before.

Passes: a range shuffle of the texts by id; tokenisation (once, words cached by the
worker, as letters and marks apart and in lower case) into a raw table; counting; encoding; decoding.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..session import ship_by_value
from .common import worker_cache, write_table
from .sentencepiece import by_bytes

ship_by_value(__name__)

SCALE_BITS = 20
LANES = 128
STEPS = 512
BLOCK = LANES * STEPS
CHECKPOINT_STEPS = 256
SEGMENT_IDS = 1 << 20
_LOW = np.uint64(1 << 31)
_WORD_CACHE = 500_000
WINDOW = 4 << 20  # text cut at once


# ---------------------------------------------------------------- the coder
def scaled_frequencies(counts: np.ndarray, scale_bits: int = SCALE_BITS) -> np.ndarray:
    """Counts to positive integers that sum to ``2**scale_bits``; unseen ids get 1, so any
    id can be coded. The rounding error goes to the most frequent ids."""
    total = 1 << scale_bits
    if len(counts) >= total:
        raise ValueError("vocabulary too large for the scale")
    seen = max(int(counts.sum()), 1)
    freq = np.maximum(1, counts.astype(np.float64) * (total - len(counts)) / seen).astype(np.int64)
    while (off := total - int(freq.sum())) != 0:
        order = np.argsort(-freq, kind="stable")
        if off > 0:
            freq[order[0]] += off
        else:
            take = np.minimum(freq[order] - 1, -off)
            freq[order] -= np.minimum(take, np.maximum(0, -off - np.append(0, np.cumsum(take)[:-1])))
    return freq


class Coder:
    """Encodes and decodes blocks with one frequency table."""

    def __init__(self, freq: np.ndarray, scale_bits: int = SCALE_BITS):
        self.bits = np.uint64(scale_bits)
        self.freq = freq.astype(np.uint64)
        self.start = np.append(0, np.cumsum(freq)[:-1]).astype(np.uint64)
        self.slot = np.repeat(np.arange(len(freq), dtype=np.int32), freq)

    def encode(self, ids: np.ndarray) -> bytes:
        """Blocks of ``BLOCK`` ids (the last one shorter), one after the other."""
        whole = len(ids) // BLOCK * BLOCK
        out = self._encode(ids[:whole].reshape(-1, STEPS, LANES), BLOCK) if whole else []
        if whole < len(ids):
            rest = ids[whole:]
            steps = -(-len(rest) // LANES)
            pad = np.concatenate([rest, np.full(steps * LANES - len(rest), rest[-1], rest.dtype)])
            out += self._encode(pad.reshape(1, steps, LANES), len(rest))
        return b"".join(out)

    def _encode(self, ids: np.ndarray, n: int) -> list[bytes]:
        blocks, steps, lanes = ids.shape
        state = np.full((blocks, lanes), _LOW, np.uint64)
        word = np.zeros((steps, blocks, lanes), np.uint32)
        out = np.zeros((steps, blocks, lanes), bool)
        marks = {}
        for t in range(steps - 1, -1, -1):
            f, c = self.freq[ids[:, t]], self.start[ids[:, t]]
            big = state >= f << (np.uint64(63) - self.bits)
            word[t], out[t] = state.astype(np.uint32), big
            state = np.where(big, state >> np.uint64(32), state)
            q = state // f
            state = (q << self.bits) + (state - q * f) + c
            if t % CHECKPOINT_STEPS == 0:
                marks[t] = state.copy()
        made = []
        per_step = out.sum(2)
        for b in range(blocks):
            words = word[:, b][out[:, b]]
            offset = np.append(0, np.cumsum(per_step[:, b]))[sorted(marks)].astype("<u4")
            crc = zlib.crc32(ids[b].ravel()[:n].astype("<u4").tobytes())
            head = b"TLR1" + struct.pack("<5I", n, lanes, len(marks), len(words), crc)
            states = np.stack([marks[t][b] for t in sorted(marks)]).astype("<u8")
            made.append(head + states.tobytes() + offset.tobytes() + words.astype("<u4").tobytes())
        return made

    def decode(self, data: bytes) -> np.ndarray:
        """All ids of the concatenated blocks; raises if a checksum is wrong."""
        blocks, at = [], 0
        while at < len(data):
            block, at = _parse(data, at)
            blocks.append(block)
        out = []
        i = 0
        while i < len(blocks):  # neighbours of equal length go together
            j = i
            while j < len(blocks) and blocks[j]["n"] == blocks[i]["n"]:
                j += 1
            out.append(self._decode(blocks[i:j]))
            i = j
        return np.concatenate(out) if out else np.zeros(0, np.int32)

    def _decode(self, blocks: list[dict], checkpoint: int = 0) -> np.ndarray:
        n, lanes = blocks[0]["n"], blocks[0]["lanes"]
        steps = -(-n // lanes)
        first = checkpoint * CHECKPOINT_STEPS
        words = np.zeros((len(blocks), max(len(b["words"]) for b in blocks) + 1), np.uint64)
        for r, b in enumerate(blocks):
            words[r, : len(b["words"])] = b["words"]
        state = np.stack([b["states"][checkpoint] for b in blocks]).astype(np.uint64)
        at = np.array([b["offset"][checkpoint] for b in blocks], np.int64)
        ids = np.zeros((len(blocks), steps - first, lanes), np.int32)
        low, row = np.uint64((1 << int(self.bits)) - 1), np.arange(len(blocks))[:, None]
        for t in range(steps - first):
            low_part = state & low
            sym = self.slot[low_part]
            ids[:, t] = sym
            state = self.freq[sym] * (state >> self.bits) + low_part - self.start[sym]
            need = state < _LOW
            place = np.cumsum(need, axis=1)
            got = words[row, np.where(need, at[:, None] + place - 1, 0)]
            state = np.where(need, (state << np.uint64(32)) | got, state)
            at += place[:, -1]
        if checkpoint:
            return ids.reshape(len(blocks), -1)[:, : n - first * lanes].ravel()
        flat = ids.reshape(len(blocks), -1)[:, :n]
        for r, b in enumerate(blocks):
            if zlib.crc32(flat[r].astype("<u4").tobytes()) != b["crc"]:
                raise ValueError("block checksum does not match")
        return flat.ravel()

    def decode_from(self, data: bytes, checkpoint: int) -> np.ndarray:
        """The ids of the first block of ``data`` from one of its checkpoints on."""
        return self._decode([_parse(data, 0)[0]], checkpoint)


def _parse(data: bytes, at: int) -> tuple[dict, int]:
    if data[at : at + 4] != b"TLR1":
        raise ValueError("not a block")
    n, lanes, marks, words, crc = struct.unpack_from("<5I", data, at + 4)
    at += 24
    states = np.frombuffer(data, "<u8", marks * lanes, at).reshape(marks, lanes)
    at += marks * lanes * 8
    offset = np.frombuffer(data, "<u4", marks, at)
    at += marks * 4
    return {"n": n, "lanes": lanes, "crc": crc, "states": states, "offset": offset, "words": np.frombuffer(data, "<u4", words, at)}, at + words * 4


# ---------------------------------------------------------------- tokenisation
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers

    cache = worker_cache(f"tokenizer {path}")
    if "t" not in cache:
        tok = Tokenizer.from_file(path)
        kinds = np.full(256, _MARK, np.uint8)
        kinds[np.r_[0:33, 39, 127:256]] = _ODD
        kinds[[10, 32]] = _GAP
        kinds[48:58] = _DIGIT
        kinds[np.r_[65:91, 97:123]] = _LETTER
        kinds[[x.content.encode()[0] for x in tok.get_added_tokens_decoder().values()]] = _ODD
        last = np.zeros(1 << 16, bool)
        vocab = tok.get_vocab(with_added_tokens=False)
        if all(c + "</w>" in vocab for c in pre_tokenizers.ByteLevel.alphabet()):  # every word has an end
            last[[i for w, i in vocab.items() if w.endswith("</w>") and i < len(last)]] = True
        cache["fast"] = Tokenizer(Tokenizer.from_file(path).model)  # for pieces that are split and in lower case already
        cache["fast"].pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        cache["kinds"], cache["last"] = kinds.tobytes(), last
        cache["cut"] = np.flatnonzero((kinds != _ODD) & (kinds != _GAP)).astype(np.uint8).tobytes() + bytes(range(0x80, 0xC0)) + b"\xc3"
        cache["words"], cache["flat"], cache["n"], cache["at"] = {}, np.zeros(0, "<u2"), np.zeros(0, np.int64), np.zeros(0, np.int64)
        cache["t"] = tok
    return cache


def tokenise(texts: list[str | None], path: str) -> list[bytes]:
    """Ids of every whole text as little-endian 16-bit integers, without special tokens."""
    ids, cut = token_ids(pa.array(texts, pa.large_string()), path)
    return [ids[i:j].tobytes() for i, j in zip(cut.tolist(), cut[1:].tolist())]


# Kinds of bytes. ODD ones (beyond Latin-1 letters, white space, the apostrophe of "'s", whatever
# begins an added token) leave the whole of what stands between spaces to the tokenizer.
_GAP, _LETTER, _DIGIT, _MARK, _ODD = range(5)
_LOWER = bytes(range(256)).lower()
_BREAK = re.compile(rb"[ \n]")
_CUT = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+|[0-9]|[!-/:-@\[-`{-~]+")  # what is cut off as one piece


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, one after the other, and where each text's begin (one more at
    the end). NULL has none.

    The tokenizer splits at white space and takes runs of letters, runs of marks and
    single digits apart, and ignores case. So texts are cut there, in windows that end at
    a space or line end, and the tokenizer gets each distinct piece once.
    """
    cache = _tokenizer(path)
    texts = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_string()), ""), pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
    if not len(texts):
        return np.zeros(0, "<u2"), np.zeros(1, np.int64)
    rows = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2], np.uint8, int(rows[-1] - rows[0]), int(rows[0]))
    rows = rows - rows[0]
    out, cut, at, done = [], np.zeros(len(rows), np.int64), 0, 0
    while at < len(data):
        end = at + WINDOW
        if end < len(data):
            end = _BREAK.search(data, end).end()  # each text is followed by one
        flat, ends, place = _window_ids(data[at:end], cache)
        some = slice(*np.searchsorted(rows, [at, min(end, len(data))]))
        cut[some] = done + ends[np.searchsorted(place, rows[some] - at)]
        out.append(flat)
        at, done = end, done + len(flat)
    cut[-1] = done
    return np.concatenate(out), cut


def _window_ids(raw: np.ndarray, cache: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids of a window, how many stand before each piece (and in all), and where the pieces begin."""
    text = raw.tobytes()
    kind = np.frombuffer(bytearray(text.translate(cache["kinds"])), np.uint8)
    low = np.frombuffer(bytearray(text.translate(_LOWER)), np.uint8)
    lead = np.flatnonzero(raw == 0xC3)  # U+00C0 to U+00FF: letters but for two
    lead = lead[(raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER
    low[lead + 1] |= 0x20 * (raw[lead + 1] < 0x9F).astype(np.uint8)
    odd = np.flatnonzero(kind == _ODD)
    if len(odd):
        gaps = np.flatnonzero(kind == _GAP)
        word = np.unique(np.searchsorted(gaps, odd))
        start = np.append(-1, gaps)[word] + 1
        size = np.append(gaps, len(raw))[word] - start
        whole = np.repeat(start - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
        kind[whole] = _ODD
        low[whole] = raw[whole]
    inside = kind != _GAP
    first = inside & ((np.diff(kind, prepend=np.uint8(_GAP)) != 0) | (kind == _DIGIT))
    place = np.flatnonzero(first)
    if not len(place):
        return np.zeros(0, "<u2"), np.zeros(1, np.int64), place
    low = low[inside]
    starts = np.append(np.flatnonzero(first[inside]), len(low))
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(place), [None, pa.py_buffer(starts), pa.py_buffer(low)]).dictionary_encode()
    which = _known(pieces.dictionary.to_pylist(), cache)[pieces.indices.to_numpy()]
    n = cache["n"][which]
    ends = np.append(0, np.cumsum(n))
    return cache["flat"][np.repeat(cache["at"][which] - ends[:-1], n) + np.arange(ends[-1])], ends, place


def _known(pieces: list[bytes], cache: dict) -> np.ndarray:
    """The places of pieces in the worker's ``n`` (their ids), ``at`` and ``flat``; new ones are encoded."""
    known = cache["words"]
    new = [w for w in pieces if w not in known]
    if len(known) + len(new) > _WORD_CACHE:
        known.clear()
        cache["flat"], cache["n"] = cache["flat"][:0], cache["n"][:0]
        new = pieces
    if new:
        cut, rest = [], []
        for w in new:
            (cut if _CUT.fullmatch(w) and not w.translate(None, cache["cut"]) else rest).append(w)
        got = [*_encode(cut, cache["fast"], cache, 1024), *_encode(rest, cache["t"], cache, 1)]
        known.update(zip([*cut, *rest], range(len(known), len(known) + len(new))))
        cache["flat"] = np.concatenate([cache["flat"], *[g[0] for g in got]])
        cache["n"] = np.concatenate([cache["n"], *[g[1] for g in got]])
        cache["at"] = np.append(0, np.cumsum(cache["n"])[:-1])
    return np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))


def _encode(words: list[bytes], tok, cache: dict, together: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The ids of words and the number of each, in groups. So many words ``together`` stand in
    a line and are told apart by the ids that end a word; a line without one end a word is
    encoded word by word."""
    for a in range(0, len(words), 4096):
        lines = [words[i : min(i + together, a + 4096)] for i in range(a, min(a + 4096, len(words)), together)]
        got = tok.encode_batch_fast([b" ".join(x).decode() for x in lines], add_special_tokens=False)
        if together == 1:
            yield _joined(got)
            continue
        for line, e in zip(lines, got):
            ids = np.array(e.ids, "<u2")
            ends = np.flatnonzero(cache["last"][ids]) + 1
            if len(ends) == len(line) and ends[-1] == len(ids):
                yield ids, np.diff(ends, prepend=0)
            else:
                yield _joined(cache["t"].encode_batch_fast([w.decode() for w in line], add_special_tokens=False))


def _joined(got: list) -> tuple[np.ndarray, np.ndarray]:
    ids = [e.ids for e in got]
    return np.fromiter(chain.from_iterable(ids), "<u2"), np.fromiter(map(len, ids), np.int64, len(ids))


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", name: str = "token-files") -> tuple[DataFrame, Coder]:
    """Write the ids of all documents; returns the files as a table, and the coder.

    Each document's ids are followed by ``end_id``. Order: ascending id, NULL ids first,
    equal ids by a hash of the text (repeated rows are equal, so their order does not
    matter). NULL text is empty; an empty table gives no segments.
    """
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    src = src.withColumn("h", F.xxhash64("text")).repartitionByRange("id", "h").sortWithinPartitions("id", "h")
    id_type = docs.schema[id_col].dataType.simpleString()
    id_arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]
    end = np.array([end_id], "<u2").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seg, first = TaskContext.get().partitionId(), 0, 0
        ids, sizes, raw, held = [], [], [], 0

        def segment() -> pa.RecordBatch:
            row = [[part], [seg], [first], [held], [ids], [sizes], [b"".join(raw)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(id_arrow), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(row, kinds)], ["part", "seg", "first", "n", "ids", "sizes", "raw"])

        for b in batches:
            for x, y in by_bytes(b.column(1), WINDOW):
                found, at = token_ids(b.column(1).slice(x, y - x), tokenizer_path)
                for i, p, q in zip(b.column(0).slice(x, y - x).to_pylist(), at.tolist(), at[1:].tolist()):
                    ids.append(i), sizes.append(q - p + 1), raw.append(found[p:q].tobytes() + end)
                    held += q - p + 1
                    if held >= SEGMENT_IDS:
                        yield segment()
                        seg, first = seg + 1, first + held
                        ids, sizes, raw, held = [], [], [], 0
        if ids:
            yield segment()

    schema = f"part int, seg int, first long, n long, doc_id array<{id_type}>, n_tokens array<long>, data binary"
    raw = write_table(src.mapInArrow(cut, schema), name + "-raw")

    vocab = _tokenizer(tokenizer_path)["t"].get_vocab_size(with_added_tokens=True)
    if vocab > 1 << 16:
        raise ValueError("ids must fit 16 bits")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocab, np.int64)
        for b in batches:
            for data in b.column(0):
                total += np.bincount(np.frombuffer(data.as_buffer(), "<u2"), minlength=vocab)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])

    counted = raw.select("data").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()  # one row per vocabulary id at most
    counts = np.zeros(vocab, np.int64)
    counts[counted["id"].to_numpy()] = counted["n"].to_numpy()
    coder = Coder(scaled_frequencies(counts))
    freq = docs.sparkSession.sparkContext.broadcast(scaled_frequencies(counts))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq.value)
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                data = coder.encode(np.frombuffer(row.column(6)[0].as_buffer(), "<u2"))
                yield pa.RecordBatch.from_arrays([*row.columns[:6], pa.array([data], pa.binary())], b.schema.names)

    return write_table(raw.mapInArrow(encode, schema), name), coder


def part_offsets(files: DataFrame) -> DataFrame:
    """``(part, before)``: ids in earlier partitions; one row per range partition."""
    rows = sorted((r["part"], r["n"]) for r in files.groupBy("part").agg(F.sum("n").alias("n")).collect())
    out, before = [], 0
    for p, n in rows:
        out.append((p, before))
        before += n
    return files.sparkSession.createDataFrame(out, "part int, before long")


def read_token_files(files: DataFrame, coder: Coder, id_type: str = "long") -> DataFrame:
    """Per document, from the files alone: ``doc_id``, ``start`` (ids before it),
    ``n_tokens`` and ``ids_crc32`` (of its ids as little-endian 32-bit integers)."""
    freq = files.sparkSession.sparkContext.broadcast(coder.freq.astype(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq.value)
        for b in batches:
            for i in range(b.num_rows):
                ids = coder.decode(b.column(5)[i].as_buffer().to_pybytes()).astype("<u4")
                sizes = b.column(4)[i].values.to_numpy()
                cut = np.append(0, np.cumsum(sizes))
                if cut[-1] != len(ids):
                    raise ValueError("segment length does not match its documents")
                crc = [zlib.crc32(ids[x:y].tobytes()) for x, y in zip(cut[:-1].tolist(), cut[1:].tolist())]
                part = pa.array(np.full(len(sizes), b.column(0)[i].as_py(), np.int32))
                start = pa.array(cut[:-1] + b.column(2)[i].as_py())
                yield pa.RecordBatch.from_arrays([part, b.column(3)[i].values, start, pa.array(sizes), pa.array(crc, pa.int64())], ["part", "doc_id", "start", "n_tokens", "ids_crc32"])

    cols = files.select("part", "seg", "first", "doc_id", "n_tokens", "data")
    got = cols.mapInArrow(run, f"part int, doc_id {id_type}, start long, n_tokens long, ids_crc32 long")
    joined = got.join(F.broadcast(part_offsets(files)), "part")
    return joined.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def ids_of(files: DataFrame, coder: Coder, id_type: str = "long") -> DataFrame:
    """``(doc_id, ids)`` decoded from the files."""
    freq = files.sparkSession.sparkContext.broadcast(coder.freq.astype(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq.value)
        for b in batches:
            for i in range(b.num_rows):
                ids = coder.decode(b.column(2)[i].as_buffer().to_pybytes())
                cut = np.append(0, np.cumsum(b.column(1)[i].values.to_numpy())).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0)[i].values, pa.ListArray.from_arrays(pa.array(cut), pa.array(ids))], ["doc_id", "ids"])

    return files.select("doc_id", "n_tokens", "data").mapInArrow(run, f"doc_id {id_type}, ids array<int>")

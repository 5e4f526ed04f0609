"""S2-S4 for documents of any size: a JSON list read in byte ranges.

A VARIANT holds 128 MiB and a row 2 GiB, so a large chat export is never one value.
Spark's text reader cuts the file in byte ranges (any store Spark reads) and, with ``}``
as the line separator, into pieces that end where an object may end. What a piece means
depends on what stands before it: is its start inside a string, and how many brackets
are open? Both are prefix sums:

* a piece has a number of quotes that no backslash escapes, and a change of depth for
  each of the two states it may start in; escapes never cross a piece, since ``\\}`` is
  not JSON;
* within a byte range a window sums quotes and both depth changes; a table with one row
  for each range carries parity and depth from range to range;
* a piece that ends outside strings at depth 1 ends an entry of the list. Pieces are
  grouped by the number of such ends before them into chunks: one object with whatever
  smaller values precede it. A chunk is parsed strictly on its own.

The document is valid exactly if the file starts with ``[``, every chunk is a list body
that follows a comma, and the last one closes the list. No task holds more than a byte
range or an entry.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.json import strict_parse_json
from ..session import null_safe_join, shared_table

_WS = " \t\n\r"
CHUNK_BLOCK = 1 << 14


def read_pieces(spark: SparkSession, path: str, glob: str | None, min_bytes: int) -> DataFrame:
    """``(path, size, block, seq, piece)``: the files above ``min_bytes``, cut at ``}``."""
    reader = spark.read.option("recursiveFileLookup", "true").option("lineSep", "}")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    meta = F.col("_metadata")
    # the metadata has the path as a URI; elsewhere it is plain text
    name = F.url_decode(F.replace(meta["file_path"], F.lit("+"), F.lit("%2B")))
    return (
        reader.text(path)
        .where(meta["file_size"] > F.lit(min_bytes))
        .select(name.alias("path"), meta["file_size"].alias("size"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("seq"), F.col("value").alias("piece"))
    )


def _n(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def _lexed(pieces: DataFrame) -> DataFrame:
    """Quotes of each piece and its change of depth, by the state at its start (out, in)."""
    plain = pieces.withColumn("plain", F.regexp_replace("piece", r"(?s)\\.", ""))
    strings = r'"[^"]*("|\z)'
    plain = plain.withColumn("out", F.regexp_replace("plain", strings, "")).withColumn("ins", F.regexp_replace(F.concat(F.lit('"'), "plain"), strings, ""))
    return plain.select(
        "path", "size", "block", "seq", "piece",
        _n(F.col("plain"), '"').cast("long").alias("quotes"),
        (_n(F.col("out"), "[{") - _n(F.col("out"), "]")).cast("long").alias("d_out"),
        (_n(F.col("ins"), "[{") - _n(F.col("ins"), "]")).cast("long").alias("d_in"),
    )


def _placed(pieces: DataFrame) -> DataFrame:
    """Every piece with its chunk number and, for its file, how the document ends."""
    rows = _lexed(pieces).repartition("path", "block")
    order = Window.partitionBy("path", "block").orderBy("seq")
    before, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("quotes_before", F.coalesce(F.sum("quotes").over(before), F.lit(0))).withColumn("final", F.lead("seq").over(order).isNull())
    for state in (0, 1):  # of the range's start
        at = (F.col("quotes_before") + state) % 2
        closes = ((at + F.col("quotes")) % 2 == 0).cast("long")  # the } after the piece
        rows = rows.withColumn(f"change{state}", F.when(at == 0, F.col("d_out")).otherwise(F.col("d_in")) - closes)
    for state in (0, 1):
        rows = rows.withColumn(f"depth{state}", F.sum(f"change{state}").over(upto))
    ranges = rows.groupBy("path", "block").agg(
        F.sum("quotes").alias("q"), F.sum("change0").alias("c0"), F.sum("change1").alias("c1"),
        F.sum(F.octet_length("piece") + 1).alias("bytes"), F.max("size").alias("size"), F.bool_and(F.is_valid_utf8("piece")).alias("utf8"),
    )
    file, earlier = Window.partitionBy("path"), Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("state", F.coalesce(F.sum("q").over(earlier), F.lit(0)) % 2)
    change = F.when(F.col("state") == 0, F.col("c0")).otherwise(F.col("c1"))
    ranges = ranges.withColumn("depth", F.coalesce(F.sum(change).over(earlier), F.lit(0)))
    # the text reader counts a } after every piece; a file that ends otherwise has one less
    open_end = F.sum("bytes").over(file) == F.col("size") + 1
    ended = F.sum("q").over(file) % 2
    ranges = ranges.select(
        "path", "block", "state", "depth",
        (F.col("block") == F.max("block").over(file)).alias("last_block"), open_end.alias("open_end"),
        F.bool_and("utf8").over(file).alias("utf8"),
        # all bytes are there (the reader drops a byte order mark), no string and no bracket is open
        ((open_end | (F.sum("bytes").over(file) == F.col("size"))) & (ended == 0) & (F.sum(change).over(file) + open_end.cast("long") == 0)).alias("closed"),
    )
    ranges = shared_table(ranges, "json-ranges")
    rows = null_safe_join(rows, ranges, ["path", "block"])
    outside = (F.col("quotes_before") + F.col("state") + F.col("quotes")) % 2 == 0
    depth = F.col("depth") + F.when(F.col("state") == 0, F.col("depth0")).otherwise(F.col("depth1"))
    rows = rows.select(
        "path", "block", "seq", "piece", "utf8", "closed",
        (F.col("last_block") & F.col("final")).alias("last"), "open_end",
        (outside & (depth == 1)).cast("long").alias("ends"),
    ).withColumn("ends_before", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    counts = rows.groupBy("path", "block").agg(F.sum("ends").alias("n"))
    counts = counts.select("path", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("chunks_before"))
    rows = null_safe_join(rows, counts, ["path", "block"])
    return rows.withColumn("chunk", F.col("chunks_before") + F.col("ends_before"))


def _chunks(placed: DataFrame, limit: int) -> DataFrame:
    """``(path, chunk, v, problem)``: the parsed list of each chunk's entries."""
    whole = placed.groupBy("path", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("block", "seq", "piece"))).alias("p"), F.bool_or("last").alias("last"),
        F.bool_or(F.col("last") & F.col("open_end")).alias("open_end"), F.bool_and("utf8").alias("utf8"), F.bool_and("closed").alias("closed"),
    )
    text = F.concat(F.array_join(F.transform("p", lambda x: x["piece"]), "}"), F.when(F.col("open_end"), F.lit("")).otherwise(F.lit("}")))
    t = whole.select("path", "chunk", "last", "utf8", "closed", F.btrim(text, F.lit(_WS)).alias("t"))
    alone = F.col("last") & (F.col("t") == "]") & (F.col("chunk") > 0)  # only closes the list
    opens = F.when(F.col("chunk") == 0, F.col("t").startswith("[")).otherwise(F.col("t").startswith(",") | alone)
    t = t.withColumn("opens", opens).withColumn("alone", alone).withColumn("inner", F.when(alone, F.col("t")).otherwise(F.expr("substr(t, 2)")))
    t = t.withColumn("inner", F.when(F.col("last") & F.col("inner").endswith("]"), F.expr("left(inner, length(inner) - 1)")).otherwise(F.col("inner")))
    ends = ~F.col("last") | F.col("t").endswith("]")
    nothing = F.btrim("inner", F.lit(_WS)) == ""
    empty = nothing & (F.col("alone") | ((F.col("chunk") == 0) & F.col("last")))
    fits = F.octet_length("inner") <= limit
    sound = F.col("opens") & ends & F.col("closed") & F.col("utf8") & (~nothing | empty)
    body = F.when(sound & fits, F.concat(F.lit("["), F.col("inner"), F.lit("]")))
    parsed = strict_parse_json(t.select("path", "chunk", "utf8", "closed", "opens", sound.alias("sound"), fits.alias("fits"), F.col("t").startswith("[").alias("list"), body.alias("body")), "body", "v")
    problem = (
        F.when(~F.col("utf8"), F.lit("invalid_utf8"))
        .when((F.col("chunk") == 0) & ~F.col("list"), F.lit("large_not_a_list"))
        .when(~F.col("sound"), F.lit("invalid_json"))
        .when(~F.col("fits"), F.lit("entry_too_large"))
        .when(F.col("v").isNull(), F.lit("invalid_json"))
    )
    return parsed.select("path", "chunk", "v", problem.alias("problem"))


# Why a document is left out, the first that holds for any of its chunks.
_PROBLEMS = ("invalid_utf8", "large_not_a_list", "invalid_json", "entry_too_large")


def large_entries(pieces: DataFrame, fmt: str, sender_map: Mapping[str, tuple[str, str]] | None = None, entry_limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(entries, quarantine)`` of large files (``read_pieces``), shaped as by
    ``explode_entries``: ``(conv_id, shape, doc_reason, turn, entry VARIANT)``.

    The same rules as for small files: a document is taken whole or, with a reason in
    ``(conv_id, reason)``, not at all; an empty list is skipped. What remains out of
    reach is one entry above the VARIANT limit (``entry_too_large``) and a large file
    that is no list (``large_not_a_list``).
    """
    from .documents import SENDER_MAP, VARIANT_LIMIT_BYTES, check_format, entry_flaws, first_is_dialogue

    check_format(fmt)
    chunks = _chunks(_placed(pieces), entry_limit or VARIANT_LIMIT_BYTES)
    chunks = chunks.withColumn("arr", F.explode(F.array(F.try_variant_get("v", "$", "array<variant>"))))
    flaws = [F.coalesce(F.exists("arr", f), F.lit(False)) for f in entry_flaws(fmt, sender_map or SENDER_MAP)]
    dialogue = F.lit(True) if fmt == "conversational" else first_is_dialogue(F.col("v"))
    chunks = shared_table(
        chunks.select(
            "path", "chunk", "v", "problem", F.coalesce(F.size("arr"), F.lit(0)).cast("long").alias("n"),
            flaws[0].alias("no_object"), flaws[1].alias("bad_text"), ((F.col("chunk") == 0) & dialogue).alias("dialogue"),
        ),
        "json-chunks",
    )
    worst = F.coalesce(*[F.max(F.when(F.col("problem") == p, F.lit(p))) for p in _PROBLEMS])
    docs = chunks.groupBy("path").agg(
        worst.alias("reason"), F.bool_or("dialogue").alias("dialogue"), F.bool_or("no_object").alias("no_object"), F.bool_or("bad_text").alias("bad_text")
    )
    quarantine = docs.where("reason IS NOT NULL").select(F.col("path").alias("conv_id"), "reason")
    flaw = F.when(F.col("dialogue"), F.when(F.col("bad_text"), F.lit("non_string_text")).when(F.col("no_object"), F.lit("non_object_entry")))
    good = docs.where("reason IS NULL").select("path", F.when(F.col("dialogue"), F.lit("dialogue")).otherwise(F.lit("instruction")).alias("shape"), flaw.alias("doc_reason"))
    # the place of a chunk's first entry: sums within blocks of chunks, and over blocks
    sizes = chunks.select("path", "chunk", "n", F.floor(F.col("chunk") / CHUNK_BLOCK).alias("part"))
    within = Window.partitionBy("path", "part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("path", "part").agg(F.sum("n").alias("n"))
    parts = parts.select("path", "part", F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    first = sizes.withColumn("first", F.coalesce(F.sum("n").over(within), F.lit(0))).join(parts, ["path", "part"])
    first = first.select("path", "chunk", (F.col("first") + F.col("earlier")).alias("first"))
    rows = chunks.where("n > 0").join(good, "path").join(first, ["path", "chunk"])
    entries = rows.select(
        F.col("path").alias("conv_id"), "shape", "doc_reason", "first", F.posexplode(F.try_variant_get("v", "$", "array<variant>")).alias("pos", "entry")
    )
    return entries.select("conv_id", "shape", "doc_reason", (F.col("first") + F.col("pos")).cast("long").alias("turn"), "entry"), quarantine

"""JSON chat exports and instruction files.

One ``.json`` file is one conversation (or one instruction file). Files are read
as bytes (``binaryFile``, content pruned where unused), checked for UTF-8,
parsed with ``try_parse_json`` into ``VARIANT`` (no schema inference, tolerant
of any top-level shape) and exploded in list order. Bad documents go to a
quarantine table with a reason instead of stopping the job. Files above the VARIANT
limit are read in byte ranges (``large_json``).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.json import strict_parse_json
from ..functions.text import py_strip
from ..session import ensure_checkpoint_dir
from .large_json import large_entries, read_pieces

# Senders of the chat export and the text field each one owns.
SENDER_MAP: Mapping[str, tuple[str, str]] = {
    "User": ("user", "userInput"),
    "Claude": ("model", "claudeOutputText"),
}
# Keys of an instruction entry.
INSTRUCTION_KEY = "instruction"
OUTPUT_KEY = "output"

FORMATS = ("instruct", "conversational")
# Spark's VARIANT value limit (128 MiB); larger documents are not parsed as one value.
VARIANT_LIMIT_BYTES = 128 * 1024 * 1024


def check_format(fmt: str) -> str:
    """Only the two dataset formats exist."""
    if fmt not in FORMATS:
        raise ValueError(f"Unknown dataset format: {fmt!r} (expected one of {FORMATS})")
    return fmt


def require_paths(spark: SparkSession, *paths: str) -> None:
    """Fail fast (before heavy work) when an input path does not exist."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if not hp.getFileSystem(conf).exists(hp):
            raise FileNotFoundError(f"input path does not exist: {p}")


def scan_docs(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """Every ``*.json`` under ``path``, recursively -> ``(path, conv_id, raw, utf8_ok)``.

    Missing folder or zero files raise. ``conv_id`` is the file path. Files whose name or
    folder starts with ``_`` or ``.``, which Spark's listing skips, are read as well.
    """
    require_paths(spark, path)
    files = _listed(spark, path, glob)
    hidden = hidden_files(spark, path, glob)
    if not hidden and files.select("path").isEmpty():
        raise FileNotFoundError(f"no {glob} files under {path}")
    # larger files are listed, never read: one of them must not stop the job
    fits = F.col("length") <= F.lit(VARIANT_LIMIT_BYTES)
    contents, big = files.where(fits).select("path", "content"), files.where(~fits).select("path", F.lit(None).cast("binary").alias("content"))
    readable = [p for p, n in hidden if 0 < n <= VARIANT_LIMIT_BYTES]
    if readable:
        contents = contents.unionByName(_read_hidden(spark, path, readable))
    if empty := [(p, b"") for p, n in hidden if not n]:
        contents = contents.unionByName(spark.createDataFrame(empty, "path string, content binary"))
    if too_large := [(p, None) for p, n in hidden if n > VARIANT_LIMIT_BYTES]:
        big = big.unionByName(spark.createDataFrame(too_large, "path string, content binary"))
    small = raw_docs(contents, key="path", content="content")
    large = raw_docs(big, key="path", content="content")
    return small.unionByName(large.withColumn("too_large", F.lit(True)))


def count_docs(spark: SparkSession, path: str, glob: str = "*.json") -> int:
    """How many files ``scan_docs`` takes; none is read."""
    return _listed(spark, path, glob).select("path").count() + len(hidden_files(spark, path, glob))


def _listed(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)


def _is_hidden(name: str, is_dir: bool) -> bool:
    """The names that Spark's file listing leaves out."""
    skipped = name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_")
    return skipped and not (is_dir and name.startswith(("_metadata", "_common_metadata")))


def hidden_files(spark: SparkSession, path: str, glob: str = "*.json") -> list[tuple[str, int]]:
    """``(path, length)`` of the files under ``path`` that Spark's listing skips because of
    their own name or a folder's, by the file system's listing, a level at a time."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    base = hadoop.Path(path)
    fs = base.getFileSystem(conf)
    if not fs.getFileStatus(base).isDirectory():
        return []
    names = hadoop.GlobFilter(glob)
    root = fs.makeQualified(base).toString().rstrip("/")
    out, level = [], root
    while True:
        for found in fs.globStatus(hadoop.Path(level + "/{_*,.*,*._COPYING_}")) or []:
            p = found.getPath()
            *above, name = p.toString()[len(root) + 1 :].split("/")
            if any(_is_hidden(x, True) for x in above) or not _is_hidden(name, found.isDirectory()):
                continue
            if not found.isDirectory():
                if names.accept(p):
                    out.append((p.toString(), found.getLen()))
                continue
            below = fs.listFiles(p, True)
            while below.hasNext():
                f = below.next()
                if names.accept(f.getPath()):
                    out.append((f.getPath().toString(), f.getLen()))
        level += "/*"
        if not fs.globStatus(hadoop.Path(level)):
            return sorted(out)


def _copy_hidden(spark: SparkSession, path: str, paths: list[str]) -> tuple[str, Column]:
    """Copies files that Spark cannot list into the shared checkpoint folder, each name with
    an ``h`` before it: the folder of the copies, and the first path from a copy's ``path``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    base = hadoop.Path(path)
    fs = base.getFileSystem(conf)
    root = fs.makeQualified(base).toString().rstrip("/")
    copies = hadoop.Path(ensure_checkpoint_dir(spark).rstrip("/") + f"/hidden-documents-{uuid.uuid4().hex}")
    shared = copies.getFileSystem(conf)
    copies = shared.makeQualified(copies)
    for p in paths:
        to = hadoop.Path(copies.toString() + p[len(root) :].replace("/", "/h"))
        hadoop.FileUtil.copy(fs, hadoop.Path(p), shared, to, False, conf)
    inner = F.regexp_replace(F.substring("path", len(copies.toString()) + 1, 1 << 30), "/h", "/")
    return copies.toString(), F.concat(F.lit(root), inner)


def _read_hidden(spark: SparkSession, path: str, paths: list[str]) -> DataFrame:
    """``(path, content)`` of files that Spark cannot list."""
    copies, original = _copy_hidden(spark, path, paths)
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(copies)
    return read.select(original.alias("path"), "content")


def read_documents(spark: SparkSession, path: str, fmt: str, glob: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """S1-S4 for files of any size: ``(entries, quarantine)`` of a folder, as ``explode_entries``
    and ``(conv_id, reason)``. Files above the VARIANT limit are read in byte ranges."""
    check_format(fmt)
    raw = scan_docs(spark, path, glob).where("NOT too_large")
    good, bad = parse_docs(raw)
    classified = classify_docs(good, fmt)
    entries = explode_entries(classified, fmt)
    quarantine = bad.select("conv_id", "reason").unionByName(skipped_docs(classified))
    sources = []
    if not _listed(spark, path, glob).where(F.col("length") > VARIANT_LIMIT_BYTES).select("path").isEmpty():
        sources.append(read_pieces(spark, path, glob, VARIANT_LIMIT_BYTES))
    if hidden := [p for p, n in hidden_files(spark, path, glob) if n > VARIANT_LIMIT_BYTES]:
        copies, original = _copy_hidden(spark, path, hidden)
        sources.append(read_pieces(spark, copies, None, VARIANT_LIMIT_BYTES).withColumn("path", original))
    for pieces in sources:
        more, left_out = large_entries(pieces, fmt)
        entries, quarantine = entries.unionByName(more), quarantine.unionByName(left_out)
    return entries, quarantine


def raw_docs(df: DataFrame, key: str, content: str) -> DataFrame:
    """Shape any ``(key, bytes-or-string)`` table as raw documents."""
    c = F.col(content)
    raw = c.cast("string")
    return df.select(
        F.col(key).cast("string").alias("path"),
        F.col(key).cast("string").alias("conv_id"),
        raw.alias("raw"),
        F.is_valid_utf8(raw).alias("utf8_ok"),
        (F.octet_length(raw) > F.lit(VARIANT_LIMIT_BYTES)).alias("too_large"),
    )


def _vtype(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is_falsy(v: Column) -> Column:
    """Python truthiness of a parsed JSON value: null, [], {}, "", false, 0."""
    t = _vtype(v)
    numeric = t.rlike("^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)")
    empty_list = t.startswith("ARRAY") & F.try_variant_get(v, "$[0]", "variant").isNull()
    return (
        F.is_variant_null(v)
        | empty_list
        | (t == "OBJECT<>")
        | ((t == "STRING") & (F.try_variant_get(v, "$", "string") == ""))
        | ((t == "BOOLEAN") & ~F.coalesce(F.try_variant_get(v, "$", "boolean"), F.lit(True)))
        | (numeric & (F.try_variant_get(v, "$", "double") == 0))
    )


def parse_docs(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tolerant parse. Returns ``(good, quarantine)``.

    good: ``(path, conv_id, v VARIANT)`` for truthy documents. quarantine:
    ``(path, conv_id, reason)`` for undecodable bytes or invalid JSON (including a
    UTF-8 BOM, ``NaN`` literals and trailing text after the value). Falsy documents
    (``[]``, ``{}``, ``null``, ``0``, ``""``, ``false``) are skipped silently.
    Duplicate keys are accepted (last wins) as in Python. Documents above the
    VARIANT limit (128 MiB of text) are quarantined as ``too_large`` here;
    ``read_documents`` reads such files in byte ranges instead.
    """
    raw.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    text = raw.select("path", "conv_id", F.when(F.col("utf8_ok") & ~F.col("too_large"), F.col("raw")).alias("raw"), "utf8_ok", "too_large")
    parsed = strict_parse_json(text, "raw", "v").drop("raw")
    reason = (
        F.when(~F.col("utf8_ok"), F.lit("invalid_utf8"))
        .when(F.col("too_large"), F.lit("too_large"))
        .when(F.col("v").isNull(), F.lit("invalid_json"))
    )
    quarantine = parsed.select("path", "conv_id", reason.alias("reason")).where(F.col("reason").isNotNull())
    good = parsed.where(F.col("v").isNotNull() & ~_is_falsy(F.col("v"))).select("path", "conv_id", "v")
    return good, quarantine


def classify_docs(parsed: DataFrame, fmt: str) -> DataFrame:
    """S3: ``shape`` = ``dialogue`` | ``instruction`` | ``skip``.

    instruct mode: a list whose *first* element is an object holding the key
    ``sender`` (even with a null value) is a dialogue; anything else goes to the
    instruction reader. conversational mode: lists are dialogues, the rest is
    skipped with a warning.
    """
    check_format(fmt)
    is_list = _vtype(F.col("v")).startswith("ARRAY")
    if fmt == "instruct":
        shape = F.when(is_list & first_is_dialogue(F.col("v")), F.lit("dialogue")).otherwise(F.lit("instruction"))
    else:
        shape = F.when(is_list, F.lit("dialogue")).otherwise(F.lit("skip"))
    return parsed.withColumn("shape", shape)


def first_is_dialogue(v: Column) -> Column:
    """Does the first element of a list hold the key ``sender``?"""
    return F.try_variant_get(v, "$[0].sender", "variant").isNotNull()


def skipped_docs(classified: DataFrame) -> DataFrame:
    """S3: the documents no reader takes in this mode, as ``(conv_id, reason)``."""
    return classified.where(F.col("shape") == "skip").select("conv_id", F.lit("skipped_shape").alias("reason"))


def _entry_array(v: Column) -> Column:
    t = _vtype(v)
    return F.when(t.startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")).when(t.startswith("OBJECT"), F.array(v))


def explode_entries(classified: DataFrame, fmt: str = "conversational", sender_map: Mapping[str, tuple[str, str]] = SENDER_MAP) -> DataFrame:
    """``(conv_id, shape, turn, entry VARIANT, doc_reason)``; list order is turn order, a
    lone object becomes a one-element list, scalars give nothing. ``doc_reason`` says why
    a dialogue is not usable as a whole; it is found in the entry array, where a document
    is still one row, so no window or shuffle gathers the document again."""
    arr = classified.withColumn("entries", F.explode(F.array(_entry_array(F.col("v")))))
    flawed = [F.exists("entries", flaw) for flaw in entry_flaws(fmt, sender_map)]
    reason = F.when(F.col("shape") == "dialogue", F.when(flawed[1], F.lit("non_string_text")).when(flawed[0], F.lit("non_object_entry")))
    return arr.select("conv_id", "shape", reason.alias("doc_reason"), F.posexplode("entries").alias("turn", "entry")).withColumn(
        "turn", F.col("turn").cast("long")
    )


def entry_flaws(fmt: str, sender_map: Mapping[str, tuple[str, str]]) -> list:
    """Tests of one entry: not an object; a truthy text field that is not a string
    (conversational mode reads every text field, instruct mode the sender's own)."""

    def bad_text(e: Column) -> Column:
        sender = F.try_variant_get(e, "$.sender", "string")
        out = F.lit(False)
        for name, (_, key) in sender_map.items():
            bad = _text_field(e, key)[1]
            out = out | (bad if fmt == "conversational" else F.coalesce(sender == name, F.lit(False)) & bad)
        return out

    return [lambda e: ~_vtype(e).startswith("OBJECT"), bad_text]


def _text_field(entry: Column, key: str) -> tuple[Column, Column]:
    """(text, bad): '' for missing/null/falsy values, the string for strings; ``bad``
    flags a truthy non-string (the reference would crash on ``.strip()``)."""
    f = F.try_variant_get(entry, f"$.{key}", "variant")
    is_str = _vtype(f) == "STRING"
    missing = f.isNull() | _is_falsy(f)
    text = F.when(is_str, F.try_variant_get(f, "$", "string")).otherwise(F.lit(""))
    bad = ~missing & ~is_str
    return F.coalesce(text, F.lit("")), F.coalesce(bad, F.lit(False))


def to_turns(entries: DataFrame, fmt: str = "conversational", sender_map: Mapping[str, tuple[str, str]] = SENDER_MAP) -> tuple[DataFrame, DataFrame]:
    """P1+P2(+P3): dialogue entries -> canonical turns ``(conv_id, turn, role, content)``.

    ``sender`` picks the role and the only text field read (case-sensitive);
    unknown or missing senders vanish. Content is stripped like ``str.strip()``.
    Documents with a non-object entry or a truthy non-string text field go to the
    returned quarantine (``conv_id, reason``) as a whole.
    """
    check_format(fmt)
    e = F.col("entry")
    sender = F.try_variant_get(e, "$.sender", "string")
    role = content = None
    for name, (r, key) in sender_map.items():
        text, _ = _text_field(e, key)
        role = F.when(sender == name, F.lit(r)) if role is None else role.when(sender == name, F.lit(r))
        content = F.when(sender == name, text) if content is None else content.when(sender == name, text)
    rows = entries.where(F.col("shape") == "dialogue")
    turns = rows.where(F.col("doc_reason").isNull()).select(
        "conv_id", "turn", role.alias("role"), F.coalesce(py_strip(content), F.lit("")).alias("content")
    ).where(F.col("role").isNotNull())
    # every flawed document has a first entry
    quarantine = rows.where(F.col("doc_reason").isNotNull() & (F.col("turn") == 0)).select("conv_id", F.col("doc_reason").alias("reason"))
    return turns, quarantine


def instruct_pairs(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Instruction entries -> ``(conv_id, turn, instruction, response, context)``.

    An entry counts only if it is an object with both keys, both values are strings
    and both are non-blank after ``str.strip()``; both are stripped, ``context`` is
    NULL. The type test uses the VARIANT type, not a cast (a cast would turn 7
    into "7"). Rejects carry a reason.
    """
    e = F.col("entry")
    ins = F.try_variant_get(e, f"$.{INSTRUCTION_KEY}", "variant")
    out = F.try_variant_get(e, f"$.{OUTPUT_KEY}", "variant")
    ins_s = py_strip(F.try_variant_get(ins, "$", "string"))
    out_s = py_strip(F.try_variant_get(out, "$", "string"))
    is_obj = _vtype(e).startswith("OBJECT")
    reason = (
        F.when(~is_obj | ins.isNull() | out.isNull(), F.lit("malformed_entry"))
        .when((_vtype(ins) != "STRING") | (_vtype(out) != "STRING"), F.lit("non_string"))
        .when((ins_s == "") | (out_s == ""), F.lit("blank"))
    )
    rows = entries.where(F.col("shape") == "instruction").select(
        "conv_id", "turn", ins_s.alias("instruction"), out_s.alias("response"), reason.alias("reason")
    )
    good = rows.where(F.col("reason").isNull()).select(
        "conv_id", "turn", "instruction", "response", F.lit(None).cast("string").alias("context")
    )
    rejects = rows.where(F.col("reason").isNotNull()).select("conv_id", "turn", "reason")
    return good, rejects

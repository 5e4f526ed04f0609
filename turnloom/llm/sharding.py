"""Sharding by a permutation-filled lookup table, in DataFrame and SQL functions only.

Every shard has its own order of preference over the slots of a prime-sized table:
``(offset + j * skip) mod slots``, both numbers taken from a hash of the shard's name.
The shards take turns; a shard claims the first slot of its order that is still free,
until all slots are taken. So each shard owns the same number of slots (one more or
less), and when a shard is added or removed few slots change hands. A row's key is
hashed to a slot; the table, whose size is the parameter ``slots``, is broadcast, so
placement is one lookup per row and never a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SHARDS = 64
SLOTS = 4099


def _hash_sql(text: str) -> str:
    """60 bits of md5 as a bigint: the same number in other SQL engines."""
    return f"CAST(conv(substring(md5({text}), 1, 15), 16, 10) AS BIGINT)"


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(spark: SparkSession, names: list[str], slots: int = SLOTS) -> DataFrame:
    """``(slot, shard)``: the filled table, ``slots`` rows. ``shard`` is an index in ``names``."""
    if not names or len(set(names)) != len(names):
        raise ValueError("shard names must be distinct and not empty")
    if not is_prime(slots) or slots < len(names):
        raise ValueError("slots must be a prime of at least the number of shards")
    n = len(names)
    listed = ", ".join("'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'" for x in names)
    turn = f"CAST(k % {n} AS INT)"
    # the place in this shard's order of the first free slot, at or after where it left off;
    # the orders are part of the folded state, so that they are worked out once
    free = f"a.own[CAST((a.offs[{turn}] + j * a.skips[{turn}]) % {slots} AS INT)] < 0"
    # (a short look ahead first: the whole order is searched only when the table is nearly full)
    near = f"get(filter(sequence(a.nxt[{turn}], least(a.nxt[{turn}] + 47, {slots - 1})), j -> {free}), 0)"
    place = f"coalesce({near}, get(filter(sequence(a.nxt[{turn}], {slots - 1}), j -> {free}), 0))"
    claim = f"CAST((b.offs[{turn}] + b.j * b.skips[{turn}]) % {slots} AS INT)"
    step = (
        f"transform(array(named_struct('own', a.own, 'nxt', a.nxt, 'offs', a.offs, 'skips', a.skips, 'j', {place})),"
        f" b -> named_struct('own', concat(slice(b.own, 1, {claim}), array({turn}), slice(b.own, {claim} + 2, {slots})),"
        f" 'nxt', transform(b.nxt, (x, i) -> IF(i = {turn}, b.j + 1, x)), 'offs', b.offs, 'skips', b.skips))[0]"
    )
    start = (
        f"named_struct('own', array_repeat(-1, {slots}), 'nxt', array_repeat(0, {n}),"
        f" 'offs', transform(names, s -> {_hash_sql("concat(s, '/offset')")} % {slots}),"
        f" 'skips', transform(names, s -> {_hash_sql("concat(s, '/skip')")} % {slots - 1} + 1))"
    )
    named = spark.range(1).selectExpr(f"array({listed}) AS names")
    filled = named.selectExpr(f"aggregate(sequence(0, {slots - 1}), {start}, (a, k) -> {step}, a -> a.own) AS own")
    return filled.selectExpr("posexplode(own) AS (slot, shard)")


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def place(df: DataFrame, key: Column, names: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """``df`` plus ``slot`` and ``shard``; columns of ``df`` with those names are replaced.

    Equal keys go to one shard, so give a key that is fine enough (a row id, not a
    source): a key with a third of the rows is a third of the rows in one shard by
    definition. A NULL key is hashed as the empty string. Repeated rows keep their
    place; an empty table gives an empty table.
    """
    names = names or shard_names()
    table = lookup_table(df.sparkSession, names, slots).select(F.col("slot").cast("long").alias("__slot"), F.col("shard").cast("int").alias("shard"))
    keyed = df.drop("slot", "shard").withColumn("__key", F.coalesce(key.cast("string"), F.lit("")))
    keyed = keyed.withColumn("slot", F.expr(f"{_hash_sql('__key')} % {slots}")).drop("__key")
    return keyed.join(F.broadcast(table), F.col("slot") == F.col("__slot")).drop("__slot")


def document_key() -> Column:
    """A document's key: its id, or for a NULL id its text, so NULL ids do not pile up."""
    return F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce(F.col("text"), F.lit(""))))


def write_shards(df: DataFrame, path: str, tasks_per_shard: int = 4) -> None:
    """Write placed rows as one folder per shard; ``tasks_per_shard`` tasks share a shard's rows."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(tasks_per_shard))
    df.repartition("shard", salt).write.partitionBy("shard").parquet(path)


# DuckDB form of the same rule over ``documents``.
ORACLE = f"""
WITH RECURSIVE names AS (SELECT i, 'shard-' || lpad(CAST(i AS VARCHAR), 5, '0') AS s FROM range({SHARDS}) r(i)),
orders AS (
  SELECT list(CAST('0x' || substr(md5(s || '/offset'), 1, 15) AS BIGINT) % {SLOTS} ORDER BY i) AS offs,
         list(CAST('0x' || substr(md5(s || '/skip'), 1, 15) AS BIGINT) % {SLOTS - 1} + 1 ORDER BY i) AS skips
  FROM names),
prefs AS (
  SELECT n.i, p.j, (o.offs[n.i + 1] + p.j * o.skips[n.i + 1]) % {SLOTS} AS slot
  FROM names n, range({SLOTS}) p(j), orders o),
prefer AS (SELECT list(ps ORDER BY i) AS lists FROM (SELECT i, list(slot ORDER BY j) AS ps FROM prefs GROUP BY i)),
fill(k, slot, own) AS (
  SELECT 0, lists[1][1], list_transform(range({SLOTS}), lambda x: x = lists[1][1]) FROM prefer
  UNION ALL
  SELECT k + 1, c, list_transform(range({SLOTS}), lambda x: own[x + 1] OR x = c)
  FROM (SELECT f.k, f.own, list_filter(p.lists[(f.k + 1) % {SHARDS} + 1], lambda s: NOT f.own[s + 1])[1] AS c FROM fill f, prefer p WHERE f.k < {SLOTS - 1}))
SELECT d.doc_id, d.slot, CAST(f.k % {SHARDS} AS INTEGER) AS shard
FROM (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))), 1, 15) AS BIGINT) % {SLOTS} AS slot FROM documents) d
JOIN fill f ON f.slot = d.slot
"""

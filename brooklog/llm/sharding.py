"""Shards by rendezvous hashing of record keys, with weights.

Each key ranks all shards by a hash of (key, shard): u in (0, 1) gives the score
-ln(u) / weight, and the lowest score wins. A shard's share of the keys is its
weight's share of all weights. Adding a shard only moves the keys it wins, and
removing one only moves the keys it had; nothing else is needed to find a record.

Keys are compared as strings; a null key is the empty string. Rows with equal
keys share a shard, by the law. Slots number the rows of each shard without
gaps, ordered by the given columns; rows that are equal in all of them are
numbered in the order they are read. One shard may hold any number of rows: they
are numbered in range-partitioned slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklog.operators.ordered import number_rows

#: Hash digits that make u: 13 hexadecimal ones are exact in a double.
DIGITS = 13
SEED = "shard"


def score(key: Column, shard: int, weight: float = 1.0, seed: str = SEED) -> Column:
    """Lower is better; the same for a key and shard whatever other shards there are."""
    if weight <= 0:
        raise ValueError("weights must be positive")
    text = F.concat(
        F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{shard}")
    )
    whole = F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double")
    u = (whole + 0.5) / float(16**DIGITS)
    return -F.log(u) / F.lit(float(weight))


def choose(key: Column, weights: Sequence[float], seed: str = SEED) -> Column:
    """Struct (score, shard) of the shard a key goes to; equal scores go to the lower one."""
    if not weights:
        raise ValueError("at least one shard is needed")
    scored = [
        F.struct(score(key, i, w, seed).alias("score"), F.lit(i).alias("shard"))
        for i, w in enumerate(weights)
    ]
    return scored[0] if len(scored) == 1 else F.least(*scored)


def assign(
    df: DataFrame, key: str, weights: Sequence[float], name: str = "shard", seed: str = SEED
) -> DataFrame:
    """Add the shard of each row, 0 to ``len(weights) - 1``, as an int. No shuffle.

    A column called ``name`` is replaced; all others stay, whatever their names.
    """
    return df.withColumn(name, choose(F.col(key), weights, seed)["shard"].cast("int"))


def with_slots(df: DataFrame, order: Sequence[str], shard: str = "shard") -> DataFrame:
    """Add ``slot``: 0, 1, 2, ... in each shard. A column of that name is replaced."""
    kept = [f"`{c}`" for c in df.columns if c != "slot"]
    rows = df.select(
        F.struct(*kept).alias("all"),
        F.col(f"`{shard}`").alias("shard"),
        *[F.col(f"`{c}`").alias(f"by{i}") for i, c in enumerate(order)],
        F.monotonically_increasing_id().alias("row"),
    )
    by = [f"by{i}" for i in range(len(order))]
    return number_rows(rows, ["shard"], [*by, "row"], "slot").select("all.*", "slot")


def plan(docs: DataFrame, shards: int) -> DataFrame:
    """Where each document goes among ``shards`` equal shards, and among one more.

    Texts are read for their size and checksum only and are not shuffled.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    key = F.col("doc_id")
    now = choose(key, [1.0] * shards)
    more = F.struct(score(key, shards).alias("score"), F.lit(shards).alias("shard"))
    rows = docs.select(
        key.cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        now.alias("now"),
    ).select(
        "doc_id", "size", "text_crc32", "law",
        F.col("now.shard").cast("int").alias("shard"),
        F.least("now", more)["shard"].cast("int").alias("grown_shard"),
    )
    return with_slots(rows, ["doc_id", "text_crc32"])


def plan_sql(shards: int) -> str:
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
polynomial AS (
  SELECT list(c ORDER BY n) AS tab FROM (
    SELECT n, list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM range(256) AS r(n))),
sums AS (
  SELECT doc_id, CAST(strlen(text) + 8 AS BIGINT) AS size,
         xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(regexp_extract_all(hex(encode(text)), '..'),
                            lambda x: ('0x' || x)::BIGINT)),
             lambda c, v: xor(c >> 8, tab[(xor(c, v) & 255) + 1]))) AS text_crc32
  FROM docs, polynomial),
scores AS (
  SELECT s.doc_id, k.shard,
         -ln((('0x' || substr(md5(concat('{SEED}:', coalesce(CAST(s.doc_id AS VARCHAR), ''),
                                         ':', k.shard)), 1, {DIGITS}))::BIGINT + 0.5)
             / {float(16**DIGITS)}) AS score
  FROM (SELECT DISTINCT doc_id FROM docs) s, range({shards} + 1) AS k(shard)),
chosen AS (
  SELECT doc_id,
         CAST(arg_min(shard, score) FILTER (shard < {shards}) AS INT) AS shard,
         CAST(arg_min(shard, score) AS INT) AS grown_shard
  FROM scores GROUP BY doc_id)
SELECT s.doc_id, s.size, s.text_crc32, 'key' AS law, c.shard, c.grown_shard,
       row_number() OVER (PARTITION BY c.shard ORDER BY s.doc_id, s.text_crc32) - 1 AS slot
FROM sums s JOIN chosen c ON c.doc_id IS NOT DISTINCT FROM s.doc_id"""

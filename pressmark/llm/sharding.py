"""Shards by weighted rendezvous hashing of record keys.

Every record scores each shard by a hash of its key and the shard, u in (0, 1), as
weight / -ln(u), and goes to the best one. Key, shard and weight alone decide, so a new shard
only takes records to itself and a removed one only gives its own away, and the shares of
records follow the weights. Slots number the records of a shard without gaps: records are
dealt into ``PARTS`` parts of the key's hash, the parts' counts are put in sequence, and only
within a part are records sorted, so no task sorts a whole shard.

The hash is the first 52 bits of the MD5 of "key:shard".

Defined results: a null key is hashed as the empty text. Rows of equal key share a shard and
have slots of their own, in the order of their size and text hash. A null text has no bytes. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

PARTS = 1024


def _bits(text: Column, digits: int) -> Column:
    """The number in the first hexadecimal digits of an MD5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("long")


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard (0 to len(weights) - 1) of a key; of equal scores the greater shard."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    text = F.coalesce(key.cast("string"), F.lit(""))
    scores = []
    for shard, weight in enumerate(weights):
        uniform = (_bits(F.concat(text, F.lit(f":{shard}")), 13).cast("double") + 0.5) / 2.0**52
        scores.append(F.struct((F.lit(-float(weight)) / F.ln(uniform)).alias("score"), F.lit(shard).alias("shard")))
    return F.array_max(F.array(*scores))["shard"]


def assigned(documents: DataFrame, shards: int = 24, weights: list[float] | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (with one more shard)."""
    weights = weights or [1.0] * shards
    data = F.coalesce("text", F.lit("")).cast("binary")
    key = F.col("doc_id")
    part = F.pmod(_bits(F.coalesce(key.cast("string"), F.lit("")), 8), F.lit(PARTS)).cast("int")
    rows = documents.select(
        "doc_id", (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
        rendezvous(key, weights).alias("shard"), rendezvous(key, [*weights, 1.0]).alias("grown_shard"), part.alias("part"),
    )
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("rows"))
    # shards x PARTS rows, whatever the input
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "size", "text_crc32")
    numbered = rows.withColumn("number", F.row_number().over(within)).join(F.broadcast(offsets), ["shard", "part"])
    slot = (F.col("offset") + F.col("number") - 1).cast("long")
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", slot.alias("slot"), "grown_shard")


def write_shards(documents: DataFrame, key: str, weights: list[float], target: str, column: str = "shard") -> None:
    """Write all columns as one folder a shard; a shard is as many files as tasks hold rows of it."""
    documents.withColumn(column, rendezvous(F.col(key), weights)).write.partitionBy(column).parquet(target)


def _crc_table() -> list[int]:
    """CRC-32 of each byte, from the reflected polynomial."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


def oracle(shards: int = 24) -> str:
    """The same as DuckDB SQL; the checksum is worked out byte by byte."""
    def best(count: int) -> str:
        scores = [
            f"{{'score': -1.0 / ln((('0x' || substr(md5(key || ':{i}'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0), 'shard': {i}}}"
            for i in range(count)
        ]
        return f"list_max([{', '.join(scores)}]).shard"

    table = ", ".join(f"{v}::BIGINT" for v in _crc_table())
    return f"""
WITH keyed AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 8 AS size, coalesce(doc_id::VARCHAR, '') AS key,
         hex(encode(coalesce(text, ''))) AS digits FROM documents
), summed AS (
  SELECT doc_id, size, key, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(1, length(digits), 2), lambda i: ('0x' || substr(digits, i, 2))::BIGINT)),
           lambda sum, byte: xor(sum >> 8, ([{table}])[(xor(sum, byte) & 255) + 1]))) AS text_crc32 FROM keyed
), dealt AS (
  SELECT doc_id, size, text_crc32, {best(shards)} AS shard, {best(shards + 1)} AS grown_shard,
         ('0x' || substr(md5(key), 1, 8))::BIGINT % {PARTS} AS part FROM summed
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY part, doc_id, size, text_crc32) - 1 AS slot FROM dealt"""

"""Rendezvous (highest random weight) hashing of record keys over weighted shards.

Every (key, shard) pair gets a pseudorandom number u in (0, 1) from MD5; a record goes
to the shard with the largest ``weight / -ln(u)``. The choice depends only on the key
and the shard's own weight, so adding a shard moves records only into the new one and
removing a shard moves only its own records.

Defined results: a null key hashes as a value of its own (no text prints as it), so
null keys share a shard; equal keys always share one. A null text has 0 bytes and the
checksum of the empty text. Repeated rows get slots of their own. Input columns other
than those named are ignored, so clashing names do no harm. An empty table gives an
empty result.

DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import documents

SHARDS = 16
#: Hex digits of the hash that make the number: 52 bits, exact in a double.
HEX_DIGITS = 13
#: Hex digits of the slot bucket: 4096 buckets in every shard are numbered in parallel.
BUCKET_DIGITS = 3


def key_text(keys: Sequence[Column]) -> Column:
    """One text of all key columns; null differs from every value."""
    return F.concat_ws("|", *[F.when(k.isNull(), F.lit("~")).otherwise(
        F.concat(F.lit("="), k.cast("string"))) for k in keys])


def unit_hash(text: Column) -> Column:
    """Uniform double in (0, 1) from the first 52 bits of MD5."""
    head = F.conv(F.substring(F.md5(text.cast("binary")), 1, HEX_DIGITS), 16, 10).cast("double")
    return (head + 0.5) / float(16 ** HEX_DIGITS)


def choose_shard(key: Column, weights: Sequence[float]) -> Column:
    """The rendezvous shard of a key text; ``weights[i]`` > 0 is the share of shard i."""
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("weights must be positive and at least one")
    bids = [F.struct((F.lit(float(w)) / -F.log(unit_hash(F.concat(key, F.lit(f"@{i}"))))).alias("bid"),
                     F.lit(-i).alias("id")) for i, w in enumerate(weights)]
    best = bids[0] if len(bids) == 1 else F.greatest(*bids)
    return (-best["id"]).cast("int")


def number_slots(df: DataFrame, shard: str, bucket: str, order: Sequence[str], slot: str) -> DataFrame:
    """Add gapless positions 0, 1, ... inside every shard, ordered by (bucket, order).

    No shard is ever sorted as a whole: equal rows are counted first, buckets are
    summed apart, and each bucket numbers its rows from the sum of the earlier ones.
    Returns one row per input row with the columns shard, bucket, order and slot.
    """
    cols = [shard, bucket, *order]
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__copies"))
    per_bucket = counted.groupBy(shard, bucket).agg(F.sum("__copies").alias("__rows"))
    before = Window.partitionBy(shard).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.select(
        F.col(shard).alias("__s"), F.col(bucket).alias("__b"),
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    inside = (Window.partitionBy(shard, bucket).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = counted.withColumn("__at", F.coalesce(F.sum("__copies").over(inside), F.lit(0)))
    joined = placed.join(starts, (F.col(shard) == F.col("__s")) & (F.col(bucket) == F.col("__b")))
    first = F.col("__start") + F.col("__at")
    return joined.select(*cols, F.explode(F.sequence(first, first + F.col("__copies") - 1)).alias(slot))


def shard_documents(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and the shard under ``grown`` weights."""
    raw = F.col("text").cast("binary")
    key = key_text([F.col("doc_id")])
    sized = docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("text_crc32"),
        choose_shard(key, weights).alias("shard"),
        (choose_shard(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        F.substring(F.md5(F.concat(F.lit("slot"), key).cast("binary")), 1, BUCKET_DIGITS).alias("bucket"))
    return number_slots(sized, "shard", "bucket", ["doc_id", "text_crc32", "size", "grown_shard"], "slot")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 16 equal shards by key, with the shard if there were 17."""
    out = shard_documents(documents(spark, sf_dir), [1.0] * SHARDS, [1.0] * (SHARDS + 1))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                      "grown_shard")

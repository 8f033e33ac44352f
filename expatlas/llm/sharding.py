"""Sharding by jump consistent hashing, in DataFrame functions only."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from expatlas.llm.common import bucket_digits, order_key, running_totals
from expatlas.scratch import materialize


def _whole(x: int) -> Column:
    return F.lit(Decimal(x))


def jump_shard(key: Column, shards: int) -> Column:
    """Shard 0 .. ``shards`` - 1 of a 64-bit key (null counts as 0).

    Each step moves the key through a linear congruential generator modulo 2**64 (decimals hold the
    exact product) and jumps ahead; the last position below ``shards`` is the shard. With one more
    shard a key either stays or moves to the new shard.
    """
    key = F.coalesce(key.cast("long"), F.lit(0)).cast("decimal(20,0)")
    key = F.when(key < 0, key + _whole(2**64)).otherwise(key).cast("decimal(20,0)")
    start = F.struct(key.alias("k"), F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def step(s: Column, _: Column) -> Column:
        moved = ((s["k"] * _whole(2862933555777941757) + 1) % _whole(2**64)).cast("decimal(20,0)")

        def jump(k: Column) -> Column:
            top = (k - k % _whole(2**33)) / _whole(2**33)
            ahead = (s["j"] + 1).cast("double") * (F.lit(2147483648.0) / (F.round(top).cast("long") + 1).cast("double"))
            return F.struct(k.alias("k"), s["j"].alias("b"), F.floor(ahead).cast("long").alias("j"))

        return F.when(s["j"] >= shards, s).otherwise(F.transform(F.array(moved), jump)[0])

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda s: s["b"].cast("int"))


def shard_documents(documents: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Place every document by the ``key`` law and number the rows of each shard without gaps.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``. ``size`` is the number of
    UTF-8 bytes plus 1; a null text has size 1 and the checksum of the empty string. A null id counts
    as key 0, repeated ids share a shard, and slots follow ``order_key`` with ties by id, size and
    checksum. Other columns are not carried, so their names cannot clash. An empty table gives none.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = documents.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        jump_shard(F.col(doc_id), shards).alias("shard"),
        jump_shard(F.col(doc_id), shards + 1).alias("grown_shard"),
        order_key(F.col(doc_id)).alias("_ord"),
    )
    rows = materialize(rows, "sharded")
    digits = bucket_digits(rows.count(), shards)
    rows = rows.withColumn("_bucket", F.substring("_ord", 1, digits))
    placed = running_totals(rows, "shard", "_bucket", ["_ord", "doc_id", "size", "text_crc32"], {"slot": F.lit(1).cast("long")})
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")

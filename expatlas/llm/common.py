"""Expressions and steps that several of the operators share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(doc_id: Column) -> Column:
    """A stable pseudo-random order of rows that any SQL engine can repeat; null ids come first."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))


def row_key(doc_id: Column, text: Column) -> Column:
    """128 bits that stand for a row's id and text; null differs from every value."""
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("")) for c in (doc_id, text)]
    return F.unhex(F.md5(F.concat(parts[0], F.lit("\n"), parts[1])))


def stream_key(doc_id: Column, size: Column) -> Column:
    """An order like ``order_key`` that tells rows of one id, or without one, apart by their size."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), size.cast("string")))


def bucket_digits(rows: int, groups: int, per_bucket: int = 512) -> int:
    """Hex digits of ``order_key`` that cut ``groups`` even groups into buckets of about ``per_bucket`` rows."""
    return max(1, math.ceil(math.log(max(rows, 1) / (max(groups, 1) * per_bucket), 16))) if rows else 1


def running_totals(df: DataFrame, group: str, bucket: str, order: list, values: dict[str, Column]) -> DataFrame:
    """Add, for each ``out: value``, the total of ``value`` over the rows that come before in the group.

    Rows of a group are ordered by ``bucket`` and then ``order``. The totals of the buckets are summed
    first and only that small table is ordered by group, so that no task holds a whole group.
    ``group`` and ``bucket`` must not be null.
    """
    sums = df.groupBy(group, bucket).agg(*[F.sum(v).alias(f"_s_{k}") for k, v in values.items()])
    before = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(group, bucket, *[F.coalesce(F.sum(f"_s_{k}").over(before), F.lit(0)).alias(f"_b_{k}") for k in values])
    within = Window.partitionBy(group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = df.select("*", *[F.coalesce(F.sum(v).over(within), F.lit(0)).alias(f"_w_{k}") for k, v in values.items()])
    joined = inside.join(base, [group, bucket])
    return joined.select(*df.columns, *[(F.col(f"_b_{k}") + F.col(f"_w_{k}")).alias(k) for k in values])


_MARK_BITS = 27


def marks(hashes: DataFrame, column: str) -> DataFrame:
    """A bit map of 2**27 places with a bit for each of the hashes: 16 MB at most, whatever their number."""
    place = F.col(column).bitwiseAND((1 << _MARK_BITS) - 1) + 1
    return hashes.groupBy(F.bitmap_bucket_number(place).alias("_mark_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_marks"))


def with_mark(df: DataFrame, column: str, found: DataFrame, out: str = "_marked") -> DataFrame:
    """Add whether a hash may be among the marked ones; false is certain, true needs an exact join.

    The bit map's size is bounded by construction, so it is broadcast at any scale.
    """
    place = F.col(column).bitwiseAND((1 << _MARK_BITS) - 1) + 1
    bit = F.bitmap_bit_position(place).cast("int")
    octet = F.conv(F.hex(F.substring("_marks", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    joined = df.withColumn("_mark_bucket", F.bitmap_bucket_number(place)).join(F.broadcast(found), "_mark_bucket", "left")
    return joined.withColumn(out, F.coalesce(F.getbit(octet, bit % 8) == 1, F.lit(False))).drop("_mark_bucket", "_marks")

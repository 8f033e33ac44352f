"""Quality control over a table of reads (item_id, mate, read_no, h1, seq, h2, qual)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def classify_reads(reads: DataFrame) -> DataFrame:
    """Add ``status``: incomplete, bad_encoding, unequal or good; the first that applies."""
    bad = F.coalesce(F.col("seq").rlike(r"[^\x20-\x7e]"), F.lit(False)) | F.coalesce(F.col("qual").rlike(r"[^\x21-\x7e]"), F.lit(False))
    status = F.when(F.col("qual").isNull() | F.col("seq").isNull() | F.col("h2").isNull(), "incomplete").when(bad, "bad_encoding").when(F.length("seq") != F.length("qual"), "unequal").otherwise("good")
    return reads.withColumn("status", status)


def read_summary(reads: DataFrame) -> DataFrame:
    """Library size and problem counts of an item; a pair is good if both mates are."""
    rank = F.expr("array_position(array('incomplete', 'bad_encoding', 'unequal', 'good'), status)")
    pairs = classify_reads(reads).groupBy("item_id", "read_no").agg(F.min(rank).alias("worst"), F.count("*").alias("mates"), F.max(F.when(F.col("mate") == 1, F.length("seq"))).alias("l1"), F.max(F.when(F.col("mate") == 2, F.length("seq"))).alias("l2"))
    good = F.col("worst") == 4
    return pairs.groupBy("item_id").agg(F.count_if(good).alias("libsize"), F.avg(F.when(good, F.col("l1"))).alias("avgLen_R1"), F.avg(F.when(good, F.col("l2"))).alias("avgLen_R2"), F.count_if(F.col("worst") == 1).alias("incomplete"), F.count_if(F.col("worst") == 2).alias("bad_encoding"), F.count_if(F.col("worst") == 3).alias("unequal"))


def layout(reads: DataFrame) -> DataFrame:
    """SE, PE, or the mate to keep where mates differ in number or in headers (without ``length=``)."""
    name = F.regexp_replace(F.regexp_replace("h1", r"\s*length=\d+", ""), r"^([@+]?\S+?)[./][12](\s|$)", "$1$2")
    rows = reads.groupBy("item_id", "read_no").agg(F.max(F.when(F.col("mate") == 1, name)).alias("n1"), F.max(F.when(F.col("mate") == 2, name)).alias("n2"), F.sum(F.when(F.col("mate") == 1, F.length("seq"))).alias("b1"), F.sum(F.when(F.col("mate") == 2, F.length("seq"))).alias("b2"))
    items = rows.groupBy("item_id").agg(F.count("n1").alias("r1"), F.count("n2").alias("r2"), F.count_if(F.col("n1") != F.col("n2")).alias("differ"), F.coalesce(F.sum("b1"), F.lit(0)).alias("bases1"), F.coalesce(F.sum("b2"), F.lit(0)).alias("bases2"))
    uneven = (F.col("r1") != F.col("r2")) | (F.col("differ") > 0)
    kind = F.when((F.col("r1") == 0) | (F.col("r2") == 0), "SE").when(uneven, F.when(F.col("bases1") >= F.col("bases2"), "keep_R1").otherwise("keep_R2")).otherwise("PE")
    return items.select("item_id", kind.alias("layout"))


def item_flags(reads: DataFrame) -> DataFrame:
    """Empty and colour-space items, by the first read."""
    first = F.min_by("seq", F.struct("mate", "read_no"))
    return reads.groupBy("item_id").agg((F.count("seq") == 0).alias("empty"), F.coalesce(first.rlike(r"^T[\d.]+$"), F.lit(False)).alias("color_space"))


def accept(items: DataFrame, least: int = 100_000) -> DataFrame:
    """Accepted items; a pair too small as such is looked at as its larger mate."""
    size = F.when(F.col("layout") == "PE", F.greatest("pairs", F.greatest("r1", "r2"))).otherwise(F.greatest("r1", "r2"))
    ok = ~F.col("empty") & ~F.col("color_space") & (size >= least)
    kind = F.when((F.col("layout") == "PE") & (F.col("pairs") < least), F.when(F.col("r1") >= F.col("r2"), "keep_R1").otherwise("keep_R2")).otherwise(F.col("layout"))
    return items.select("item_id", F.coalesce(ok, F.lit(False)).alias("accepted"), kind.alias("layout"))


def quality_encoding(reads: DataFrame, every: int = 10, first: int = 5000) -> DataFrame:
    """Offset of the quality code, guessed from the range of a fixed sample of each item's reads."""
    codes = F.transform(F.split("qual", ""), lambda c: F.ascii(c))
    seen = reads.filter((F.col("read_no") % every == 0) & (F.col("read_no") < first) & (F.length("qual") > 0))
    span = seen.groupBy("item_id").agg(F.min(F.array_min(codes)).alias("low"), F.max(F.array_max(codes)).alias("high"))
    return span.withColumn("offset", F.when(F.col("low") < 59, 33).when(F.col("high") > 74, 64).otherwise(33))

"""Mixing sources to target weights with a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from expatlas.llm.common import bucket_digits, order_key, running_totals, stream_key, word_count
from expatlas.scratch import materialize


def source_targets(stats: DataFrame, weights: tuple = (5, 2, 1), max_repeats: int = 3) -> DataFrame:
    """Targets of sources (one row each: ``source``, ``source_size``) that share the total of all sizes.

    Sources in code-point order, null last, take ``weights`` in turn. A target stops at
    ``max_repeats`` times the source's size and the excess is shared among the others by weight: with
    the sources ordered by the level at which they stop, the level that shares everything is the
    largest of the levels reached. The table has one row a source.
    """
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    named = stats.withColumn("src", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long") - 1)
    named = named.withColumn("weight", F.element_at(cycle, (F.col("src") % len(weights) + 1).cast("int")).cast("long"))
    named = named.withColumn("_cap", F.col("source_size") * max_repeats)
    by_stop = Window.orderBy((F.col("_cap") / F.col("weight")).asc(), "src")
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_stop.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    leveled = named.withColumn("_level", left.cast("double") / F.sum("weight").over(onward).cast("double"))
    leveled = leveled.withColumn("_level", F.max("_level").over(whole))
    leveled = leveled.withColumn("target", F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("weight")))
    return leveled.select("src", "source", "source_size", "weight", "target", F.floor("target").cast("long").alias("quota"))


def block_schedule(targets: DataFrame, slots: int) -> DataFrame:
    """The slots of the mix: ``slot`` (time), ``src`` and ``rank`` (the source's how-manieth slot).

    Slot t stands at the van der Corput point reverse_bits(t) / ``slots`` (a power of two), and the
    source whose interval of the cumulative targets holds the point fills it. Bit reversal is its own
    inverse, so each source lists the points of its own interval and reads its slots off them; no range
    join is needed. A source's points are its share of all, rounded up or down; what rounding down
    leaves over gets one slot behind all others, in the order of the sources.
    """
    so_far = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    edges = targets.select("src", F.coalesce(F.sum("quota").over(so_far), F.lit(0)).alias("_from"), "quota", F.sum("quota").over(whole).alias("_all"))
    place = f"(({{}}) * {slots}L + _all - 1) div _all"  # rounded up, in whole numbers: right below 2**63 / slots words
    edges = edges.filter("quota > 0").select("src", F.expr(place.format("_from")).alias("_first"), F.expr(place.format("_from + quota")).alias("_end"))
    edges = materialize(edges, "edges")
    bits = slots.bit_length() - 1
    piece = 4096
    pieces = edges.filter("_first < _end").select("src", "_first", "_end", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_end") - F.col("_first") - 1) / piece))).alias("_piece"))
    pieces = pieces.repartition("src", "_piece")
    begin = F.col("_first") + F.col("_piece") * piece
    points = pieces.select("src", F.explode(F.sequence(begin, F.least(begin + piece, F.col("_end")) - 1)).alias("point"))
    slot = F.conv(F.reverse(F.lpad(F.bin("point"), bits, "0")), 2, 10).cast("long")
    found = points.select("src", slot.alias("slot")).withColumn("_bucket", F.floor(F.col("slot") / piece))
    ranked = running_totals(found, "src", "_bucket", ["slot"], {"rank": F.lit(1).cast("long")}).select("src", "slot", "rank")
    return ranked.union(edges.select("src", F.col("src") + slots, F.col("_end") - F.col("_first")))


def mix_sources(
    documents: DataFrame, weights: tuple = (5, 2, 1), max_repeats: int = 3, slots: int = 1 << 16,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """Words that the mix takes of every document, and when.

    Each source's documents stand in a shuffled stream, again and again up to ``max_repeats`` times,
    cut into equal blocks, of so many words that ``slots`` of them hold the whole mix. The schedule
    gives every slot to a source; a source's slot of rank r takes its block r, until the source has its
    target, rounded down to a word; its last block ends there, and its further slots stay empty.

    Returns ``doc_id, source, size, source_size, target, taken, first_slot, slots, text_key``, a row for
    each row of the input; ``slots`` are those in which the document begins in each pass that takes it,
    ``max_repeats`` at most, and ``first_slot`` is the first of them, null if nothing is taken. Null texts and texts without words have size 0 and give 0; a null source is a source
    of its own; repeated rows (equal id, source and text) are counted before anything is ordered and
    mixed each for itself; an empty table gives none. ``text_key`` is a hash of the text by which rows
    can be found again. Other columns are not carried.
    """
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), F.xxhash64(text).alias("text_key"))
    rows = materialize(rows.groupBy("doc_id", "source", "size", "text_key").agg(F.count("*").alias("_copies")), "sizes")
    stats = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("_copies")).alias("source_size"), F.count("*").alias("_rows"))
    stats = materialize(stats, "sources")
    targets = materialize(source_targets(stats.drop("_rows"), weights, max_repeats), "targets")
    known = stats.agg(F.max("_rows")).first()[0] or 0
    block = max(1, -(-(targets.agg(F.sum("quota")).first()[0] or 0) // slots))
    schedule = block_schedule(targets, slots)

    named = targets.withColumnRenamed("source", "_source")
    placed = rows.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    placed = placed.withColumn("_ord", stream_key(F.col("doc_id"), F.col("size")))
    placed = placed.withColumn("_bucket", F.substring("_ord", 1, bucket_digits(known, 1)))
    order = ["_ord", "doc_id", "size", "text_key"]
    totals = {"_start": F.col("size") * F.col("_copies"), "_row": F.col("_copies")}
    placed = running_totals(placed, "src", "_bucket", order, totals).withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
    placed = placed.withColumns({"_start": F.col("_start") + F.col("_copy") * F.col("size"), "_row": F.col("_row") + F.col("_copy")})
    placed = materialize(placed, "streams")

    passes = F.sequence(F.lit(0).cast("long"), F.lit(max_repeats - 1).cast("long"))
    seen = placed.filter("size > 0").select("src", "_row", "size", "source_size", "quota", "_start", F.explode(passes).alias("_pass"))
    seen = seen.withColumn("_from", F.col("_pass") * F.col("source_size") + F.col("_start")).filter("_from < quota")
    seen = seen.withColumn("_to", F.least(F.col("_from") + F.col("size"), F.col("quota")))
    seen = seen.withColumn("rank", F.explode(F.sequence(F.floor(F.col("_from") / block), F.floor((F.col("_to") - 1) / block))))
    words = F.least(F.col("_to"), (F.col("rank") + 1) * block) - F.greatest(F.col("_from"), F.col("rank") * block)
    passed = seen.join(schedule, ["src", "rank"]).groupBy("src", "_row", "_pass").agg(F.sum(words).alias("_words"), F.min("slot").alias("_slot"))
    taken = passed.groupBy("src", "_row").agg(F.sum("_words").alias("taken"), F.min("_slot").alias("first_slot"), F.array_sort(F.collect_list("_slot")).alias("slots"))

    out = placed.join(taken, ["src", "_row"], "left")
    none = F.array().cast("array<bigint>")
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot", F.coalesce("slots", none).alias("slots"), "text_key")


def mixed_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself, in the order of its slots: every document as often as the mix takes it, a part taken counting as a whole.

    Documents of which nothing is taken are not in the mix. Each time that a document is taken it
    stands at the slot of that pass, so that its copies lie as far apart as the passes of its source.
    Rows equal in id and text take as many slots each, those of the earliest of them. All columns stay;
    the order is that of the result's partitions and of the rows in them.
    """
    found = mix_sources(documents, doc_id=doc_id, text=text, source=source, **options).filter("taken > 0")
    taken = found.select("doc_id", "text_key", F.posexplode("slots").alias("_time", "_slot"))
    taken = taken.groupBy("doc_id", "text_key", "_time").agg(F.count("*").alias("_n"), F.min("_slot").alias("_slot"))
    shares = taken.groupBy("doc_id", "text_key").agg(F.sum("_n").alias("_n"), F.max("_n").alias("_rows"), F.array_sort(F.collect_list("_slot")).alias("_slots"))
    slots = F.slice("_slots", 1, F.ceil(F.col("_n") / F.col("_rows")).cast("int"))
    shares = shares.select(F.col("doc_id").alias("_doc_id"), F.col("text_key").alias("_text_key"), slots.alias("_slots"))
    joined = documents.join(shares, F.col(doc_id).eqNullSafe(F.col("_doc_id")) & (F.xxhash64(text) == F.col("_text_key")))
    placed = joined.withColumn("_slot", F.explode("_slots")).withColumn("_tie", order_key(F.col(doc_id)))
    return placed.repartitionByRange("_slot", "_tie").sortWithinPartitions("_slot", "_tie").select(*documents.columns)

"""Near-duplicate lines by a segment-partition edit join."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from expatlas.llm.common import marks, with_mark
from expatlas.llm.components import connected_components
from expatlas.llm.edit_stars import crowd_pairs, letter_parities, may_be_near
from expatlas.scratch import discard, materialize, ship

_KEY_BITS = (1 << 48) - 1


def allowed(length: Column, edits: int, letters_per_edit: int) -> Column:
    """Edits that lines may be apart: one for each so many letters of the shorter one, ``edits`` at most."""
    return F.least(F.lit(edits), F.floor(length / letters_per_edit)).cast("int")


def segment_bounds(length: Column, segments: Column, i: Column) -> tuple[Column, Column]:
    """First place (from 1) and length of the i-th (from 0) of ``segments`` even parts; later parts take the rest."""
    short, even = F.floor(length / segments).cast("int"), segments - (length % segments)
    return (short * i + F.greatest(i - even, F.lit(0)) + 1).cast("int"), (short + F.when(i >= even, 1).otherwise(0)).cast("int")


def _key(i: Column, length: Column, part: Column) -> Column:
    return F.xxhash64(i, length, part).bitwiseAND(_KEY_BITS)


def _each(rows: DataFrame, named: str, values: list[tuple]) -> DataFrame:
    """Every row with every one of a few fixed tuples of whole numbers, whose columns ``named`` lists.

    One small expression over these columns makes a line's keys. An array with an expression for each
    key grows past the size at which the JVM compiles a method, and is then interpreted.
    """
    names = named.split()
    fixed = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(names, row, strict=True)]) for row in values])
    return rows.select("*", F.inline(fixed))


def index_keys(lines: DataFrame, edits: int, letters_per_edit: int) -> DataFrame:
    """``hash, key`` for every segment of lines ``hash, line, n``: which one, the line's length, the letters.

    A line has one segment more than the edits that its length allows.
    """
    rows = _each(lines.withColumn("most", allowed(F.col("n"), edits, letters_per_edit)), "i", [(i,) for i in range(edits + 1)])
    n, i = F.col("n"), F.col("i")
    rows = rows.filter((F.col("most") > 0) & (i <= F.col("most")))
    return rows.select("hash", _key(i, n, F.substring("line", *segment_bounds(n, F.col("most") + 1, i))).alias("key"))


def probe_keys(lines: DataFrame, edits: int, letters_per_edit: int) -> DataFrame:
    """``hash, key`` under which a line finds every line no longer than itself and as near as that line's length allows.

    Lines of each length from n - ``edits`` to n keep at least one of their segments. With ``most``
    edits allowed the i-th one moves by at most i edits made before it and by the rest made after it,
    which leaves few places to try.
    """
    tries = [
        (most, shorter, i, shift)
        for most in range(1, edits + 1)
        for shorter in range(most + 1)
        for i in range(most + 1)
        for shift in range(max(-i, shorter - (most - i)), min(i, shorter + (most - i)) + 1)
    ]
    rows = _each(lines, "most shorter i shift", tries)
    length, i = F.col("n") - F.col("shorter"), F.col("i")
    start, size = segment_bounds(length, F.col("most") + 1, i)
    at = start + F.col("shift")
    fits = (allowed(length, edits, letters_per_edit) == F.col("most")) & (at >= 1) & (at + size - 1 <= F.col("n"))
    return rows.filter(fits).select("hash", _key(i, length, F.substring("line", at, size)).alias("key"))


def _shared_start(a: str, b: str) -> int:
    """Letters that two texts have in common at their starts."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def edits_within(a: str, b: str, most: int) -> bool:
    """Whether the edit distance is at most ``most``, by bit-parallel steps within a diagonal band.

    A column holds 2 * ``most`` + 1 vertical differences in two bit masks that slide down one row a
    step. The distance is followed along the band's lowest diagonal to the last row and then along it.
    """
    if a == b:
        return True
    if abs(len(a) - len(b)) > most:
        return False
    i = _shared_start(a, b)
    a, b = a[i:], b[i:]
    j = _shared_start(a[::-1], b[::-1])
    a, b = a[: len(a) - j], b[: len(b) - j]
    m, n = len(a), len(b)
    if m <= most or n <= most:
        row = list(range(n + 1))
        for i in range(1, m + 1):
            diagonal, row[0] = row[0], i
            for j in range(1, n + 1):
                diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (a[i - 1] != b[j - 1]))
        return row[n] <= most
    mask = (1 << 2 * most + 1) - 1
    up, down, distance = mask >> most << most, 0, most
    for j in range(1, n + 1):
        c, top = b[j - 1], j - 1 - most  # the band's column, row by row
        match = sum(1 << k for k in range(2 * most + 1) if 0 <= top + k < m and a[top + k] == c)
        diagonal = (((match & up) + up) ^ up | match | down) & mask
        right = down | ~(diagonal | up) & mask
        left = diagonal & up
        if j <= m - most:
            distance += not diagonal >> 2 * most & 1
        else:
            row = m - j + most
            distance += (right >> row & 1) - (left >> row & 1)
        if distance > most + (n - j if j > m - most else 2 * most):
            return False
        up, down = (left | ~(diagonal >> 1 | right)) & mask, diagonal >> 1 & right
    return distance <= most


def numbered_lines(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, text_key, at, line`` of every line that is not blank; ``at`` counts from 0."""
    body = documents.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_key"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("at", "line"))
    return body.filter(F.col("line").rlike(r"\S"))


def candidate_pairs(lines: DataFrame, edits: int, letters_per_edit: int, most: int) -> DataFrame:
    """Pairs ``a < b`` of the hashes of different lines (``hash, line``) among which is every link, or a chain of links in its place.

    Lines that share a segment where near lines must are paired, if their letters' parities allow it. A segment that over ``most`` lines have
    does not pair them; they are left to ``crowd_pairs``, where a crowd makes stars instead of all its pairs.
    """
    once = lines.select("hash", "line", F.char_length("line").alias("n")).filter(F.col("n") >= letters_per_edit)
    ship(lines.sparkSession)
    named = once.withColumn("hash", F.struct("hash", F.arrow_udf(letter_parities, "int")("line").alias("odd")))
    index, probes = (f(named, edits, letters_per_edit).select(F.col("hash.hash").alias(c), F.col("hash.odd").alias(f"{c}_odd"), "key") for f, c in ((index_keys, "x"), (probe_keys, "y")))
    crowded = materialize(index.groupBy("key").count().filter(F.col("count") > most).select("key"), "crowded")
    if not crowded.isEmpty():  # one row stands for a crowd, to tell who belongs to it
        index = index.join(crowded, "key", "left_anti").select("x", "x_odd", "key").union(crowded.select(F.lit(None).cast("long"), F.lit(None).cast("int"), "key"))
    near = may_be_near(F.col("x_odd"), F.col("y_odd"), edits)
    met = probes.join(index, "key").filter(F.col("x").isNull() | ((F.col("x") != F.col("y")) & near))
    met = materialize(met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "met")
    pairs, names = met.filter("a <> b"), met.filter("a = b").select(F.col("a").alias("hash"))
    if crowded.isEmpty():
        return pairs
    likely = with_mark(once, "hash", marks(names, "hash")).filter("_marked").drop("_marked")
    crowd = materialize(likely.join(names, "hash"), "crowd")
    return pairs.union(crowd_pairs(crowd, lambda n: allowed(n, edits, letters_per_edit), edits, most)).distinct()


def wanted_lines(lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """``hash, line`` of the lines in ``pairs``.

    Most lines are in no pair; marks of bounded size keep them out of the exact join that follows.
    """
    names = materialize(pairs.select(F.explode(F.array("a", "b")).alias("hash")).distinct(), "names")  # read twice
    seen = with_mark(lines, "hash", marks(names, "hash")).filter("_marked").select("hash", "line")
    return seen.dropDuplicates(["hash"]).join(names, "hash")


def line_links(lines: DataFrame, edits: int = 2, letters_per_edit: int = 8, most: int = 32) -> DataFrame:
    """Pairs ``a, b`` of line hashes whose lines are near, enough of them to connect all that such pairs connect."""
    pairs = materialize(candidate_pairs(lines, edits, letters_per_edit, most), "pairs")
    known = materialize(wanted_lines(lines, pairs), "lines")
    first = pairs.join(known.select(F.col("hash").alias("a"), F.col("line").alias("one")), "a")
    both = first.join(known.select(F.col("hash").alias("b"), F.col("line").alias("other")), "b").select("a", "b", "one", "other")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            near = [edits_within(p, q, min(edits, min(len(p), len(q)) // letters_per_edit)) for p, q in zip(x["one"], x["other"], strict=True)]
            yield x.loc[near, ["a", "b"]]

    return both.mapInPandas(verify, "a long, b long")


def first_lines(lines: DataFrame, first: DataFrame) -> DataFrame:
    """``hash, line`` of each different line once; only lines that may be repeated are shuffled to find that out."""
    often = first.filter("n > 1").select("hash", "second", "first")
    tagged = with_mark(lines, "hash", marks(often, "hash"))
    single = tagged.filter("not _marked").select("hash", "line")
    place = F.xxhash64("doc_id", "text_key", "at")
    firsts = marks(often.select(F.xxhash64("first.doc_id", "first.text_key", "first.at").alias("place")), "place")
    some = with_mark(tagged.filter("_marked").drop("_marked").withColumn("place", place), "place", firsts).filter("_marked")
    own = F.col("first").isNull() | F.col("first").eqNullSafe(F.struct("doc_id", "text_key", "at"))
    return single.union(some.join(often, ["hash", "second"], "left").filter(own).dropDuplicates(["hash"]).select("hash", "line"))


def repeated_lines(documents: DataFrame, edits: int = 2, letters_per_edit: int = 8, most: int = 32, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Numbers of the lines to remove: ``doc_id, text_key, removed`` for documents that lose any.

    Lines are equal if two 64-bit hashes are.
    """
    lines = numbered_lines(documents, doc_id, text).withColumn("hash", F.xxhash64("line")).withColumn("second", F.xxhash64(F.lit(1), "line"))
    places = materialize(lines.select("doc_id", "text_key", "at", "hash", "second"), "places")
    first = materialize(places.groupBy("hash", "second").agg(F.min(F.struct("doc_id", "text_key", "at")).alias("first"), F.count("*").alias("n")), "first")
    once = materialize(first_lines(lines, first), "once")
    classes = connected_components(materialize(line_links(once, edits, letters_per_edit, most), "near"))
    discard(once)
    first = first.join(classes.withColumnRenamed("node", "hash"), "hash", "left")
    shared = first.filter("root is not null").groupBy("root").agg(F.min("first").alias("kept")).hint("rebalance")
    owner = first.filter("n > 1 or root is not null").join(shared, "root", "left").select("hash", "second", F.coalesce("kept", "first").alias("kept"))
    again = places.join(materialize(owner, "owners"), ["hash", "second"]).filter(~F.struct("doc_id", "text_key", "at").eqNullSafe(F.col("kept")))
    return again.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("at")).alias("removed"))


def dedup_lines(documents: DataFrame, edits: int = 2, letters_per_edit: int = 8, most: int = 32, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Remove every line that is a near copy of an earlier one anywhere in the table.

    Lines are linked when equal, or when apart by one edit for each ``letters_per_edit`` letters of the
    shorter one at most, ``edits`` in all: with 8, lines of 16 letters and more by two edits, "yes" and
    "no" by none. Of each class of lines reachable by links the first stays, by doc_id, a hash of the
    text, and place. Blank lines always stay. Returns the input with ``text`` rewritten and the columns
    ``_n_lines`` (not blank) and ``_n_removed`` added.

    A null text stays null and has no lines. Rows equal in id and text are one document here and keep
    the same lines. An empty table gives none. Equal lines are one node before anything is joined, so
    a line's copies are never paired; segments that over ``most`` different lines share make stars (see
    ``edit_stars``), so that pairs grow with the number of lines. Links are checked on letters.
    """
    removed = materialize(repeated_lines(documents, edits, letters_per_edit, most, doc_id, text), "removed").withColumnsRenamed({"doc_id": "_doc_id", "text_key": "_text_key", "removed": "_removed"})
    lines = F.size(F.filter(F.split(F.col(text), "\n", -1), lambda x: x.rlike(r"\S")))
    keyed = documents.withColumns({"_key": F.xxhash64(text), "_n_lines": F.when(F.col(text).isNull(), 0).otherwise(lines).cast("long")})
    keyed = with_mark(keyed, "_key", marks(removed.select("_text_key").distinct(), "_text_key"))
    same = F.col(doc_id).eqNullSafe(F.col("_doc_id")) & (F.col("_key") == F.col("_text_key"))
    rows = keyed.filter("_marked").join(removed, same, "left").select(*documents.columns, "_n_lines", "_removed")
    untouched = keyed.filter("not _marked").select(*documents.columns, "_n_lines", F.lit(0).cast("long").alias("_n_removed"))
    kept = T.StructType([*[rows.schema[c] for c in documents.columns], T.StructField("_n_lines", T.LongType()), T.StructField("_n_removed", T.LongType())])

    def without(batch: pa.RecordBatch) -> pa.RecordBatch:
        gone = batch.column("_removed").to_pylist()
        texts = [
            None if x is None else x if not g else "\n".join([line for i, line in enumerate(x.split("\n")) if i not in g])
            for x, g in zip(batch.column(text).to_pylist(), map(set, (g or () for g in gone)), strict=True)
        ]
        columns = [pa.array(texts, pa.string()) if c == text else batch.column(c) for c in kept.names[:-1]]
        return pa.RecordBatch.from_arrays([*columns, pa.array([len(g or ()) for g in gone], pa.int64())], kept.names)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):  # texts are few at a time in Python
                yield without(batch.slice(i, 500))

    return rows.mapInArrow(rewrite, kept).union(untouched)

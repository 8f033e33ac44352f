"""SimHash near-duplicates: segment popcounts as a grid, an exact check behind it."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from expatlas.llm.common import marks, row_key, with_mark
from expatlas.llm.components import connected_components
from expatlas.scratch import discard, materialize, ship

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(text: str, words_per_shingle: int = 3) -> np.ndarray:
    """64-bit hashes of all runs of so many words, ASCII letters in lower case; a shorter text is one shingle."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    k = min(words_per_shingle, len(words))
    starts = [0, *ends]
    shingles = (joined[a : b - 1] for a, b in zip(starts, ends[k - 1 :], strict=False))
    n = len(words) - k + 1
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, 42) for s in shingles), np.uint64, n)


def fingerprint(text: str, words_per_shingle: int = 3) -> int:
    """64-bit SimHash as a signed integer: a bit is set if it is in over half of the shingles' hashes."""
    hashes = shingle_hashes(text, words_per_shingle)
    n = len(hashes)
    counts = np.zeros(64, np.int64)
    for part in range(0, n, 65536):
        octets = hashes[part : part + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(documents: DataFrame, words_per_shingle: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp, key`` of every whole text; a null text has no words and fingerprint 0. ``key`` hashes id and text."""
    ship(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([fingerprint(x, words_per_shingle) for x in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), fps, batch.column("key")], ["doc_id", "fp", "key"])

    rows = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), row_key(F.col(doc_id), F.col(text)).alias("key"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp bigint, key binary")


def cell(fp: Column, segments: int) -> Column:
    """Bit counts of the segments of a fingerprint, four bits for each count."""
    width = 64 // segments
    counts = [F.shiftleft(F.bit_count(F.shiftrightunsigned(fp, width * i).bitwiseAND((1 << width) - 1)).cast("long"), 4 * i) for i in range(segments)]
    return reduce(lambda a, b: a.bitwiseOR(b), counts)


def steps(segments: int) -> list[int]:
    """What to add to a cell to reach every other cell within Manhattan distance 2, in one of the two directions."""
    one = [1 << 4 * i for i in range(segments)]
    pairs = [(a, b) for i, a in enumerate(one) for b in one[i + 1 :]]
    return [*one, *[2 * a for a in one], *[a + b for a, b in pairs], *[a - b for a, b in pairs]]


def choose_segments(nodes: DataFrame) -> int:
    """8 or 16 segments, whichever makes fewer rows: cells to probe, or pairs to check within cells.

    Both find every link; finer cells cost more probes and save checks where many fingerprints are
    alike. A check costs about a twentieth of a probe. Pairs of neighbouring cells are taken to be as
    many as pairs in a cell.
    """
    best = []
    for segments in (8, 16):
        crowd = nodes.groupBy(cell(F.col("fp"), segments)).count().agg(F.sum("count"), F.sum(F.col("count").cast("double") ** 2)).first()
        probes = len(steps(segments)) + 1
        best.append(((crowd[0] or 0) * probes + (crowd[1] or 0) * probes / 20, segments))
    return min(best)[1]


def hamming_links(nodes: DataFrame, segments: int | None = None) -> DataFrame:
    """Pairs ``a, b`` of the distinct fingerprints ``fp`` of ``nodes`` that differ in 1 or 2 bits.

    If two fingerprints differ in two bits, their segments' bit counts differ by two in sum. So each
    fingerprint probes its own cell and those within Manhattan distance 2 (each pair of cells from one
    side only), and the pairs that meet are checked exactly. Everything is one equi-join on cells.
    """
    segments = segments or choose_segments(nodes)
    own = F.col("own")
    grid = nodes.select(F.col("fp"), cell(F.col("fp"), segments).alias("own"))
    probes = grid.select(F.col("fp").alias("a"), F.explode(F.array(own, *[own + F.lit(s) for s in steps(segments)])).alias("own"))
    met = probes.join(grid.select(F.col("fp").alias("b"), "own"), "own")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2
    once = (F.col("a") < F.col("b")) | ((F.col("a") != F.col("b")) & (cell(F.col("a"), segments) != F.col("own")))
    return met.filter(near & once).select("a", "b")


def near_duplicates(documents: DataFrame, words_per_shingle: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Components of documents whose fingerprints differ in at most two bits.

    Returns ``doc_id, fp, key, component, component_id`` (a fingerprint that stands for the component,
    and the smallest doc_id reachable by links), a row for each row. Equal fingerprints are merged before anything is joined, so that a group of copies, however
    large, is one node. Null and word-free texts share fingerprint 0 and are linked like any other; a
    null id is never the smallest, and a component of null ids alone has a null id. Repeated rows
    stay. An empty table gives none; other columns are not carried.
    """
    rows = materialize(fingerprints(documents, words_per_shingle, doc_id, text), "fingerprints")
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    linked = connected_components(hamming_links(nodes))
    firsts = linked.join(nodes, F.col("node") == F.col("fp")).groupBy("root").agg(F.min("first_id").alias("component_id")).hint("rebalance")
    labels = linked.join(firsts, "root").select(F.col("node").alias("fp"), "root", "component_id")
    labels = nodes.join(labels, "fp", "left").select("fp", F.coalesce("root", "fp").alias("component"), F.coalesce("component_id", "first_id").alias("component_id"))
    labels = materialize(labels, "labels")
    discard(nodes, linked)
    return rows.join(labels, "fp").select("doc_id", "fp", "key", "component", "component_id")


def keep_one(documents: DataFrame, words_per_shingle: int = 3, least: float | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one of each component left: that of the smallest doc_id (null ids last).

    Without ``least``, links are fingerprints within two bits; with it, they are all pairs whose sets of
    shingles have at least that Jaccard similarity, counted exactly (see ``shingle_join``). Rows equal in id and text are one document, known by a 128-bit hash of both. All columns stay.
    """
    if least is None:
        found = near_duplicates(documents, words_per_shingle, doc_id, text)
    else:
        from expatlas.llm.shingle_join import similar_documents

        found = similar_documents(documents, words_per_shingle, least, doc_id, text)
    best = found.groupBy("component").agg(F.count("*").alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "key")).alias("best"))
    several = found.join(best.filter("n > 1").select("component", F.col("best.key").alias("_best")), "component")
    several = materialize(several.select(F.col("key").alias("_key"), (F.col("key") == F.col("_best")).alias("_kept")).distinct(), "several")
    rows = documents.withColumn("_key", row_key(F.col(doc_id), F.col(text))).withColumn("_h", F.xxhash64("_key"))
    tagged = with_mark(rows, "_h", marks(several.select(F.xxhash64("_key").alias("_h")), "_h"))  # documents alone in their component are not shuffled
    kept = tagged.filter("_marked").join(several.filter("not _kept").select("_key"), "_key", "left_anti").dropDuplicates(["_key"])
    return kept.select(*documents.columns).union(tagged.filter("not _marked").select(*documents.columns))


def fingerprint_text(fp: Column) -> Column:
    """Sixteen lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))

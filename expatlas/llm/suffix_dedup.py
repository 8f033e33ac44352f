"""Removal of repeated passages: suffix sorting of the places where repeats can be."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from expatlas.llm.common import marks, with_mark
from expatlas.llm.suffix_sort import repeated_starts
from expatlas.scratch import discard, materialize, ship

_GRAM = 32
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base, and of its inverse, modulo 2**64."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 1 << 21)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _POWERS[name] = np.multiply.accumulate(x)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place where ``length`` bytes begin, the least hash among the 32-byte strings in them; and all the hashes.

    Equal strings have equal anchors, so all places that can repeat each other share one.
    """
    up, down = _powers(len(data) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64)])
    grams = (sums[_GRAM:] - sums[:-_GRAM]) * down[: len(data) - _GRAM + 1]
    grams ^= grams >> np.uint64(32)
    grams *= np.uint64(0xD6E8FEB86659FD93)
    grams ^= grams >> np.uint64(29)
    window = length - _GRAM + 1
    n = len(grams) - window + 1
    whole = -(-len(grams) // window) * window
    rows = np.concatenate([grams, np.full(whole - len(grams), ~np.uint64(0))]).reshape(-1, window)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[window - 1 : window - 1 + n]), grams


def _pieces_of(texts: list[bytes], length: int) -> Iterator[tuple]:
    """Runs of places with one anchor: text's number, anchor, hash of the run's bytes, first place, places,
    and whether the anchor's bytes occur more than once in the run, without which it cannot repeat itself."""
    for number, text in enumerate(texts):
        if len(text) < length:
            continue
        least, grams = (x.view(np.int64) for x in anchors(np.frombuffer(text, np.uint8), length))
        firsts = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        ends = np.append(firsts[1:], len(least))
        digest = xxhash.xxh3_64_intdigest
        hashes = np.array([digest(text[a : b + length - 1]) for a, b in zip(firsts.tolist(), ends.tolist(), strict=True)], np.uint64).view(np.int64)
        values = least[firsts]
        reach = length - _GRAM
        again = np.array([np.count_nonzero(grams[a : b + reach] == v) > 1 for a, b, v in zip(firsts.tolist(), ends.tolist(), values, strict=True)])
        yield np.full(len(firsts), number), values, hashes, firsts, ends - firsts, again


def _flag(pieces: list[bytes], reach: list[int], copies: list[int], length: int, memory: int) -> list[list[int]]:
    """Runs [a, b) of the repeated places of each piece; all places of a piece with copies are repeated."""
    flags = repeated_starts(pieces, reach, length, memory)
    out, at = [], 0
    for n, c in zip(reach, copies, strict=True):
        f = np.ones(n, bool) if c > 1 else flags[at : at + n]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], f, [False]]).astype(np.int8)))
        out.append(edges.tolist())
        at += n
    return out


def _keyed(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(F.col(doc_id).alias("doc_id"), F.xxhash64(doc_id).alias("id_key"), F.xxhash64(text).alias("text_key"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def find_repeats(documents: DataFrame, length: int = 200, shard_bytes: int = 2 << 20, hot_pieces: int = 20_000, memory: int = 256 << 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Places where a string of ``length`` bytes begins that begins elsewhere too: ``id_key,
    text_key, spans``.

    Documents are known by hashes of id and text, 128 bits together. ``spans`` lists (first place of a run of places, places). The steps:

    1. Every place gets its anchor; runs of places with one anchor are pieces (about 85 places and
       285 bytes). Pieces whose anchor occurs once, in them and elsewhere, hold no repeat.
    2. Equal pieces are merged, with the number of their copies, so that a passage copied a million
       times goes on once. If an anchor has but one piece then, and the piece cannot repeat itself, all
       of its places are repeated, and by nothing else.
    3. All other pieces are dealt out by anchor into shards of about ``shard_bytes``; in each the
       suffixes are sorted by induction and neighbours that share ``length`` bytes are marked.
    4. An anchor with over ``hot_pieces`` different pieces would make one shard too large: its places
       are dealt out singly, by a 128-bit hash of their ``length`` bytes, and counted.
    """

    ship(documents.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = [t.encode() for t in batch.column("text").to_pylist()]
            found = list(_pieces_of(coded, length))
            if found:
                number, anchor, piece, at, n, again = (np.concatenate(x) for x in zip(*found, strict=True))
                take = pa.array(number)
                yield pa.RecordBatch.from_arrays([batch.column("id_key").take(take), batch.column("text_key").take(take), pa.array(anchor), pa.array(piece), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(again)],
                                                 ["id_key", "text_key", "anchor", "piece", "at", "n", "again"])

    rows = _keyed(documents, doc_id, text)
    pieces = materialize(rows.mapInArrow(scan, "id_key long, text_key long, anchor long, piece long, at int, n int, again boolean"), "pieces")
    shared = materialize(pieces.groupBy("anchor").agg(F.count("*").alias("count"), F.max("again").alias("again")).filter("count > 1 or again").select("anchor"), "anchors")
    likely = with_mark(pieces, "anchor", marks(shared, "anchor")).filter("_marked").drop("_marked")
    held = materialize(likely.join(shared, "anchor"), "held")
    discard(pieces, shared)

    place = F.struct("id_key", "text_key", "at", "n")
    merged = held.groupBy("anchor", "piece").agg(F.count("*").alias("copies"), F.max("again").alias("again"), F.min(place).alias("p"))
    merged = materialize(merged.select("anchor", "piece", "copies", "again", "p.*"), "merged")
    kinds = merged.groupBy("anchor").agg(F.count("*").alias("pieces"), F.max("again").alias("_again"))
    kinds = merged.drop("again").join(kinds, "anchor")
    alone = (F.col("pieces") == 1) & ~F.col("_again")
    decided = kinds.filter(alone).select("anchor", "piece", F.array(F.lit(0), F.col("n")).alias("runs"))
    wanted = materialize(kinds.filter(~alone).select("anchor", "piece", "copies", "id_key", "text_key", "at", "n", (F.col("pieces") > hot_pieces).alias("crowded")), "wanted")
    cuts = wanted.groupBy("id_key", "text_key").agg(F.collect_list(F.struct("anchor", "piece", "copies", "at", "n", "crowded")).alias("cuts"))
    sources = with_mark(rows, "text_key", marks(wanted.select("text_key").distinct(), "text_key")).filter("_marked").select("id_key", "text_key", "text")
    cut = sources.join(cuts, ["id_key", "text_key"]).select(F.explode("cuts").alias("c"), F.col("text").cast("binary").alias("body"))
    cut = cut.select("c.anchor", "c.piece", "c.copies", "c.n", "c.crowded", F.substring("body", F.col("c.at") + 1, F.col("c.n") + length - 1).alias("bytes"))
    cut = materialize(cut, "cut")

    total = cut.filter("not crowded").agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    shards = max(1, -(-total // (4 * shard_bytes)), documents.sparkSession.sparkContext.defaultParallelism)
    sharded = cut.filter("not crowded").repartition(shards, "anchor").sortWithinPartitions("anchor").drop("crowded")

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []

        def done() -> pd.DataFrame:
            x = pd.concat(waiting)
            waiting.clear()
            runs = _flag(x["bytes"].tolist(), x["n"].tolist(), x["copies"].tolist(), length, memory)
            return pd.DataFrame({"anchor": x["anchor"], "piece": x["piece"], "runs": runs})

        for x in batches:
            while len(x):
                sizes = x["bytes"].map(len).cumsum().to_numpy()
                full = shard_bytes - sum(w["bytes"].map(len).sum() for w in waiting)
                if sizes[-1] <= full:
                    waiting.append(x)
                    break
                first = int(np.searchsorted(sizes, max(full, 0)))
                values = x["anchor"].to_numpy()
                later = np.flatnonzero(values[first:] != values[first])  # a shard ends where an anchor does
                end = first + int(later[0]) if len(later) else len(x)
                waiting.append(x.iloc[:end])
                x = x.iloc[end:]
                if len(x):
                    yield done()
        if waiting:
            yield done()

    flagged = sharded.mapInPandas(sort, "anchor long, piece long, runs array<int>")

    def singly(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for r in x.itertuples():
                hashes = [xxhash.xxh3_128_digest(r.bytes[i : i + length]) for i in range(r.n)]
                yield pd.DataFrame({"hash": hashes, "anchor": r.anchor, "piece": r.piece, "copies": r.copies, "at": np.arange(r.n)})

    single = cut.filter("crowded").mapInPandas(singly, "hash binary, anchor long, piece long, copies long, at int")
    seen = single.groupBy("hash").agg(F.sum("copies").alias("times")).filter("times > 1").select("hash").hint("rebalance")
    counted = single.join(seen, "hash").groupBy("anchor", "piece").agg(F.flatten(F.array_sort(F.collect_set(F.array(F.col("at"), F.col("at") + 1)))).alias("runs"))

    flagged = materialize(flagged.union(counted).filter(F.size("runs") > 0).union(decided), "flagged")
    discard(cut, wanted, merged)
    hits = held.join(flagged, ["anchor", "piece"]).groupBy("id_key", "text_key")
    return hits.agg(F.collect_set(F.struct("at", "runs")).alias("spans"))


def remove_repeats(documents: DataFrame, length: int = 200, keep_bytes: bool = False, doc_id: str = "doc_id", text: str = "text", **limits: int) -> DataFrame:
    """Remove every byte covered by a string of ``length`` bytes that also begins anywhere else.

    Texts count as UTF-8 bytes, repeats never reach over documents, overlapping ones count, and all is
    judged on the input. Returns ``doc_id, n_bytes, n_removed, n_spans`` (maximal removed runs) and
    ``kept_sha256``, with ``keep_bytes`` also the remaining bytes as ``kept`` (binary, as a cut may
    fall within a character); a row for each row. A null text counts as empty; rows equal in id and
    text are repeats of each other; an empty table gives none; other columns are not carried.
    """
    spans = materialize(find_repeats(documents, length, doc_id=doc_id, text=text, **limits), "spans")
    rows = _keyed(documents, doc_id, text)
    rows = with_mark(rows, "text_key", marks(spans.select("text_key").distinct(), "text_key"))
    hit = rows.filter("_marked").join(spans, ["id_key", "text_key"], "left").select("doc_id", "text", "spans")
    clear = rows.filter("not _marked").select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for body, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                data = body.encode()
                gone, runs, kept = 0, 0, data
                if found:
                    change = np.zeros(len(data) + 1, np.int64)
                    for span in found:
                        edges = np.asarray(span["runs"]) + span["at"]
                        np.add.at(change, edges[::2], 1)
                        np.add.at(change, edges[1::2] + length - 1, -1)
                    covered = np.cumsum(change)[:-1] > 0
                    gone, runs = int(covered.sum()), int(covered[0]) + int((covered[1:] & ~covered[:-1]).sum())
                    kept = np.frombuffer(data, np.uint8)[~covered].tobytes()
                out.append((len(data), gone, runs, hashlib.sha256(kept).hexdigest(), *([kept] if keep_bytes else [])))
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=False)] if out else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if keep_bytes else [])]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), *([pa.binary()] if keep_bytes else [])]
    kind = rows.schema["doc_id"].dataType.simpleString()
    return hit.union(clear).mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if keep_bytes else ""))

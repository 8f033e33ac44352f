"""Exact top-k inner products through a pivot-distance index."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from expatlas.scratch import discard, materialize

_BLOCK = "size int, pivot int, ring int, block long, near double, far double, ids array<long>, rows array<long>, asks array<boolean>, vectors binary"
_CHUNK = "size int, chunk long, ids array<long>, rows array<long>, vectors binary, floors array<double>"


def _matrix(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, np.float64).reshape(n, -1)


def _best(scores: np.ndarray, ids: np.ndarray, floors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, column and score of each query's k highest scores not below its floor; ties to the smaller id."""
    cut = floors
    if scores.shape[1] > k:
        cut = np.maximum(floors, np.partition(scores, scores.shape[1] - k, axis=1)[:, -k])
    row, col = np.nonzero((scores >= cut[:, None]) & (scores > -np.inf))
    score = scores[row, col]
    order = np.lexsort((ids[col], -score, row))
    row, col, score = row[order], col[order], score[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    keep = place < k
    return row[keep], col[keep], score[keep]


class Index:
    """Pivots by vector length, and the geometry that they and the largest norm give.

    Vectors of norm up to M get one more coordinate, sqrt(M**2 - norm**2), and queries a 0 there: then
    all vectors have norm M, the distance d of a query q and a vector fulfils
    q . v = (|q|**2 + M**2 - d**2) / 2, and the triangle inequality holds for d.
    """

    def __init__(self, vectors: DataFrame, pivots: int, rings: int, sample: int) -> None:
        """Pivots are chosen farthest first from at most ``sample`` vectors in hash order."""
        self.most = {r[0]: float(r[1]) for r in vectors.groupBy("size").agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).collect()}
        rows = vectors.select("v").orderBy(F.xxhash64("v")).limit(sample).collect()
        self.rings, self.pivots = rings, {}
        for size in self.most:
            known = np.array([r[0] for r in rows if len(r[0]) == size], np.float64).reshape(-1, size)
            full = self.lifted(known) if len(known) else np.zeros((1, size + 1))
            chosen, gap = [0], np.full(len(full), np.inf)
            while len(chosen) < min(pivots, len(full)):
                gap = np.minimum(gap, ((full - full[chosen[-1]]) ** 2).sum(axis=1))
                chosen.append(int(gap.argmax()))
            self.pivots[size] = full[sorted(set(chosen))]

    def lifted(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([x, np.sqrt(np.maximum(0, self.most[x.shape[1]] - (x * x).sum(axis=1)))[:, None]])

    def width(self, size: int) -> float:
        return max(math.sqrt(self.most[size]) * 2 / self.rings, 1e-9)

    def distances(self, size: int, full: np.ndarray) -> np.ndarray:
        p = self.pivots[size]
        return np.sqrt(np.maximum(0, (full * full).sum(axis=1)[:, None] + (p * p).sum(axis=1) - 2 * full @ p.T))

    def of_queries(self, x: np.ndarray) -> np.ndarray:
        return self.distances(x.shape[1], np.hstack([x, np.zeros((len(x), 1))]))


def exact_top_k(
    vectors: DataFrame, k: int = 5, query_every: int = 50, scale: float = 256.0, vec_id: str = "vec_id", vector: str = "embedding",
    pivots: int = 32, rings: int = 48, per_block: int = 1024, per_chunk: int = 512, sample: int = 2048, meet_bytes: int = 32 << 20,
) -> DataFrame:
    """The ``k`` rows of highest integer inner product for every row whose id is divisible by ``query_every``.

    Components become floor(``scale`` * x). Each vector is keyed by its nearest pivot and the ring its
    distance falls in; blocks are pieces of rings. A query first meets the block it lives in, which
    gives it a floor for the score of its k-th neighbour and so a largest distance; by the triangle
    inequality only rings within this distance of the query's own distance to each pivot can matter.
    Those are searched nearest first and the search stops when no further block can reach the floor,
    which rises on the way. The bounds leave nothing out; pivots are fitted on a bounded sample and
    every row is indexed. Equal vectors are one in the index, with the ``k + 1`` smallest of their rows,
    more of which cannot be answers: ``k + 1`` rows are sought for every different vector that asks, the
    asking one included, which each row that asks then leaves out.

    Returns ``query_id, rank, vec_id, score``; a query with fewer other rows gets them all. Ties go to
    the smaller id. Rows with a null id or vector, with an empty vector or with null or non-finite
    components take no part. A row is never its own answer, but others of the same id may be, and each
    row of a repeated id asks for itself. Vectors of different lengths do not meet. An empty table gives none; other columns are not carried. Scores
    are exact while they stay below 2**53.
    """
    x = F.col(vector)
    finite = F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < float("inf")) & ~F.isnan(c))
    rows = vectors.filter(F.col(vec_id).isNotNull() & x.isNotNull() & (F.size(x) > 0) & finite)
    rows = rows.select(F.col(vec_id).cast("long").alias("id"), F.size(x).alias("size"), F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(scale)).cast("double")).alias("v"))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")  # ids may repeat, rows do not
    k, given = k + 1, k
    first, asks = F.slice(F.array_sort(F.collect_list(F.struct("id", "row"))), 1, k), F.max(F.col("id") % query_every == 0)
    salted = rows.groupBy("size", "v", F.pmod(F.xxhash64("row"), F.lit(1 << 16)).alias("_salt")).agg(first.alias("first"), asks.alias("asks"))
    merged = salted.groupBy("size", "v").agg(F.slice(F.array_sort(F.flatten(F.collect_list("first"))), 1, k).alias("first"), F.max("asks").alias("asks"))
    values = materialize(merged.withColumn("id", F.get("first", F.lit(0))["id"]).withColumn("row", F.monotonically_increasing_id()), "values")
    index = Index(values, pivots, rings, sample)

    def key(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for size, part in b.groupby("size"):
                x = np.stack(part["v"]).astype(np.float64)
                d = index.distances(size, index.lifted(x))
                pivot = d.argmin(axis=1)
                near = d[np.arange(len(d)), pivot]
                yield pd.DataFrame({"id": part["id"].to_numpy(), "row": part["row"].to_numpy(), "asks": part["asks"].to_numpy(bool), "size": size, "pivot": pivot, "ring": (near / index.width(size)).astype(int), "distance": near, "v": [r.tobytes() for r in x]})

    keyed = values.select("id", "row", "asks", "size", "v").mapInPandas(key, "id long, row long, asks boolean, size int, pivot int, ring int, distance double, v binary")
    order = ["size", "pivot", "ring", "distance", "id"]
    keyed = keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for (size, pivot, ring), part in b.groupby(["size", "pivot", "ring"], sort=False):
                for begin in range(0, len(part), per_block):
                    p = part.iloc[begin : begin + per_block]
                    yield pd.DataFrame({"size": [size], "pivot": [pivot], "ring": [ring], "block": [int(p["place"].iloc[0])], "near": [p["distance"].min()], "far": [p["distance"].max()],
                                        "ids": [p["id"].to_numpy()], "rows": [p["row"].to_numpy()], "asks": [p["asks"].to_numpy(bool)], "vectors": [b"".join(p["v"])]})

    blocks = materialize(keyed.mapInPandas(cut, _BLOCK), "blocks")

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The queries of a partition's blocks in chunks, each with the floor its own block gives."""
        for b in batches:
            for row in b.itertuples():
                ids, own = np.asarray(row.ids), np.asarray(row.rows)
                asks = np.flatnonzero(np.asarray(row.asks, bool))
                x = _matrix(row.vectors, len(ids))
                for begin in range(0, len(asks), per_chunk):
                    at = asks[begin : begin + per_chunk]
                    scores = x[at] @ x.T
                    floors = np.partition(scores, len(ids) - k, axis=1)[:, -k] if len(ids) > k else np.full(len(at), -np.inf)
                    yield pd.DataFrame({"size": [row.size], "id": [ids[at]], "row": [own[at]], "vectors": [x[at].tobytes()], "floors": [floors]})

    def chunk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for size, part in b.groupby("size", sort=False):
                held: list = []

                def out(held=held, size=size):
                    ids = np.concatenate([np.asarray(r.id) for r in held])
                    own = np.concatenate([np.asarray(r.row) for r in held])
                    return pd.DataFrame({"size": [size], "chunk": [0], "ids": [ids], "rows": [own], "vectors": [b"".join(r.vectors for r in held)], "floors": [np.concatenate([np.asarray(r.floors) for r in held])]})

                for r in part.itertuples():
                    if held and sum(len(h.id) for h in held) + len(r.id) > per_chunk:
                        yield out()
                        held.clear()
                    held.append(r)
                if held:
                    yield out()

    asked = blocks.mapInPandas(ask, "size int, id array<long>, row array<long>, vectors binary, floors array<double>")
    chunks = materialize(asked.mapInPandas(chunk, _CHUNK).withColumn("chunk", F.monotonically_increasing_id()), "queries")

    def reach(x: np.ndarray, floors: np.ndarray) -> np.ndarray:
        """Largest distance at which a vector can still reach the floor."""
        most = index.most[x.shape[1]]
        return np.sqrt(np.maximum(0, (x * x).sum(axis=1) + most - 2 * floors)) + 1e-6

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.itertuples():
                x = _matrix(row.vectors, len(row.ids))
                d, r = index.of_queries(x), reach(x, np.asarray(row.floors))
                last = index.rings + 1
                width = index.width(row.size)
                low = np.floor(np.clip((d - r[:, None]).min(axis=0) / width, 0, last)).astype(int)
                high = np.floor(np.clip((d + r[:, None]).max(axis=0) / width, 0, last)).astype(int)
                yield pd.DataFrame([(row.size, row.chunk, p, ring) for p in range(d.shape[1]) for ring in range(low[p], high[p] + 1)], columns=["size", "chunk", "pivot", "ring"])

    # blocks and chunks meet by so many bytes, so that a block is sent once for all chunks of a part that want it
    shares, parts = (max(1, -(-(df.agg(F.sum(F.octet_length("vectors"))).first()[0] or 0) // meet_bytes)) for df in (blocks, chunks))
    wanted = chunks.mapInPandas(plan, "size int, chunk long, pivot int, ring int")
    pairs = wanted.join(blocks.select("size", "pivot", "ring", "block"), ["size", "pivot", "ring"])
    pairs = pairs.select("size", "chunk", "block", F.pmod(F.xxhash64("block"), F.lit(shares)).alias("share"), F.pmod(F.xxhash64("chunk"), F.lit(parts)).alias("part"))
    pairs = materialize(pairs, "pairs")
    left = pairs.select("chunk", "share", "part").distinct().join(chunks, "chunk")
    right = pairs.select("block", "share", "part").distinct().join(blocks, "block").withColumnsRenamed({"size": "size_", "share": "share_", "part": "part_"})

    def search(_, asks: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        found = [_search(row, held) for row in asks.itertuples(index=False)]
        return pd.concat(found) if found else pd.DataFrame({"row": [], "other": [], "score": []})

    def _search(row, held: pd.DataFrame) -> pd.DataFrame:
        """A chunk's queries in the blocks, nearest first; blocks that its bounds exclude are passed over."""
        own, x = np.asarray(row.rows), _matrix(row.vectors, len(row.ids))
        floors, d = np.array(row.floors, np.float64), index.of_queries(x)
        gap = np.stack([np.maximum(0, np.maximum(d[:, b.pivot] - b.far, b.near - d[:, b.pivot])) for b in held.itertuples()])
        norms = (x * x).sum(axis=1) + index.most[x.shape[1]]
        none = np.zeros(0)
        rows_, ids_, others_, scores_ = none.astype(int), none.astype(np.int64), none.astype(np.int64), none
        ahead = np.minimum.accumulate(gap[(order := np.argsort(gap.min(axis=1)))][::-1], axis=0)[::-1]  # nearest of the blocks still to come
        for step, at in enumerate(order):
            if not ((norms - np.maximum(0, ahead[step] - 1e-6) ** 2) / 2 >= floors).any():
                break
            live = np.flatnonzero((norms - np.maximum(0, gap[at] - 1e-6) ** 2) / 2 >= floors)
            if not len(live):
                continue
            b = held.iloc[at]
            ids = np.asarray(b["ids"])
            scores = x[live] @ _matrix(b["vectors"], len(ids)).T
            r, c, s = _best(scores, ids, floors[live], k)
            rows_, ids_, others_, scores_ = (np.concatenate(v) for v in ((rows_, live[r]), (ids_, ids[c]), (others_, np.asarray(b["rows"])[c]), (scores_, s)))
            order_ = np.lexsort((ids_, -scores_, rows_))
            rows_, ids_, others_, scores_ = (v[order_] for v in (rows_, ids_, others_, scores_))
            place = np.arange(len(rows_)) - np.searchsorted(rows_, rows_)
            rows_, ids_, others_, scores_, place = (v[place < k] for v in (rows_, ids_, others_, scores_, place))
            full = place == k - 1
            floors[rows_[full]] = np.maximum(floors[rows_[full]], scores_[full])
        return pd.DataFrame({"row": own[rows_], "other": others_, "score": scores_.astype(np.int64)})

    found = left.groupBy("size", "share", "part").cogroup(right.groupBy("size_", "share_", "part_")).applyInPandas(search, "row long, other long, score long")
    answers = values.select(F.col("row").alias("other"), F.explode("first").alias("_f"))
    met = found.join(answers, "other").select("row", "score", F.col("_f.id").alias("vec_id"), F.col("_f.row").alias("_own"))
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id", "_own")
    met = met.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= k).groupBy("row").agg(F.collect_list(F.struct("_n", "score", "vec_id", "_own")).alias("_best"))
    queries = rows.filter(F.col("id") % query_every == 0).join(values.filter("asks").select(F.col("size").alias("_size"), F.col("v").alias("_v"), F.col("row").alias("_value")), (F.col("size") == F.col("_size")) & (F.col("v") == F.col("_v")))
    told = queries.select(F.col("id").alias("query_id"), F.col("row").alias("_row"), "_value").join(met, F.col("_value") == F.col("row"))
    others = F.filter(F.array_sort("_best"), lambda x: x["_own"] != F.col("_row"))
    done = told.select("query_id", F.posexplode(F.slice(others, 1, given)).alias("rank", "_b"))
    done = materialize(done.select("query_id", (F.col("rank") + 1).alias("rank"), "_b.vec_id", "_b.score"), "nearest")
    discard(rows, values, blocks, chunks, pairs)
    return done

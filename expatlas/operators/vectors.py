"""Wide matrices and vectors: covariance by blocks, principal components, exact nearest rows by indexes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from expatlas.operators.aggregates import numbered
from expatlas.scratch import discard, materialize, ship


def matrix_of(column: pa.Array) -> np.ndarray:
    """The rows of a list column, all of one length, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


# -- covariance --------------------------------------------------------------------------------------


def moments(vectors: DataFrame) -> DataFrame:
    """Lines of the covariance matrix: ``i, n, mean, line``; vectors that are null or hold a null take no part.

    Every task sums up its own rows as one matrix of centred products, so that a line a task and
    component is shuffled, whatever the number of rows; the tasks' matrices are shifted to the common
    mean as they are added up. A task holds p x p numbers.
    """
    ship(vectors.sparkSession)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, total = 0, np.zeros(0), np.zeros((0, 0))
        for batch in batches:
            x = matrix_of(batch.column(0))
            if not len(x):
                continue
            m = x.mean(axis=0)
            gap = x - m
            if n:
                shift = m - mean
                total += gap.T @ gap + np.outer(shift, shift) * (n * len(x) / (n + len(x)))
                mean = mean + shift * (len(x) / (n + len(x)))
            else:
                mean, total = m, gap.T @ gap
            n += len(x)
        if n:
            p = len(mean)
            lists = lambda a: pa.ListArray.from_arrays(pa.array(np.arange(p + 1) * p, pa.int32()), pa.array(a.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(range(p), pa.int32()), pa.array(np.full(p, n)), lists(np.tile(mean, (p, 1))), lists(total)], ["i", "n", "mean", "line"])

    def join(table: pa.Table) -> pa.Table:
        i, n = table.column("i")[0].as_py(), table.column("n").to_numpy().astype(float)
        means, lines = (matrix_of(table.column(c).combine_chunks()) for c in ("mean", "line"))
        mean = n @ means / n.sum()
        shift = means - mean
        line = lines.sum(axis=0) + (n * shift[:, i]) @ shift
        return pa.table({"i": pa.array([i], pa.int32()), "n": pa.array([int(n.sum())]), "mean": [mean], "line": [line / n.sum()]})

    known = vectors.select("vector").filter("vector is not null and not exists(vector, x -> x is null)")
    shape = "i int, n bigint, mean array<double>, line array<double>"
    return known.mapInArrow(part, shape).groupBy("i").applyInArrow(join, shape)


def covariance_rows(vectors: DataFrame) -> DataFrame:
    """Population covariance of the components, long: ``i, j, cov`` for ``i <= j``."""
    return moments(vectors).select("i", F.posexplode("line").alias("j", "cov")).filter("i <= j")


def shrunk_cov(vectors: DataFrame, shrinkage: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Covariance shrunk towards a multiple of the identity, and its inverse; p x p numbers come to the driver."""
    c = np.array([r["line"] for r in sorted(moments(vectors).select("i", "line").collect(), key=lambda r: r["i"])])
    c = (1 - shrinkage) * c + shrinkage * np.trace(c) / len(c) * np.eye(len(c))
    return c, np.linalg.inv(c)


def whiten(vectors: DataFrame, inverse: np.ndarray) -> DataFrame:
    """Vectors whose Euclidean distances are Mahalanobis distances; the p x p matrix is sent to the tasks."""
    root = vectors.sparkSession.sparkContext.broadcast(np.linalg.cholesky(inverse))

    @F.pandas_udf("array<double>")
    def turned(x: pd.Series) -> pd.Series:
        return pd.Series(list(np.array(list(x), np.float64) @ root.value)) if len(x) else x

    return vectors.withColumn("vector", turned("vector"))


def mahalanobis_to_mean(vectors: DataFrame, shrinkage: float = 0.0) -> DataFrame:
    """Squared distance of each row to the mean."""
    _, inverse = shrunk_cov(vectors, shrinkage)
    white = whiten(vectors, inverse)
    means = moments(white).filter("i = 0").select(F.col("mean").alias("_mean"))
    gap = F.aggregate(F.zip_with("vector", "_mean", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    return white.join(F.broadcast(means)).select("id", gap.alias("distance2"))


# -- principal components of wide tables ------------------------------------------------------------


def _blob(m: np.ndarray) -> bytes:
    return np.ascontiguousarray(m, np.float64).tobytes()


def _inverse_root(gram: np.ndarray) -> np.ndarray:
    """What makes columns with these inner products orthonormal; directions of no length are left out."""
    values, axes = np.linalg.eigh(gram)
    keep = values > values.max(initial=0) * 1e-14
    return axes[:, keep] / np.sqrt(values[keep])


class _Tall:
    """A matrix of many rows and few columns as blocks of rows: a table ``block, m``."""

    def __init__(self, table: DataFrame, rows: int, width: int, per_block: int) -> None:
        self.table, self.rows, self.width, self.per_block = materialize(table, "tall"), rows, width, per_block

    def _known(self) -> Callable[[int], int]:
        """How many rows of a block there are; holds two numbers only, as tasks get it."""
        rows, per_block = self.rows, self.per_block
        return lambda block: min(per_block, rows - block * per_block)

    def sums(self, f: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over blocks of a small matrix made of each; a few come to the driver."""
        known, width = self._known(), self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for block, m in zip(batch.column("block").to_pylist(), batch.column("m").to_pylist(), strict=True):
                    x = f(np.frombuffer(m).reshape(-1, width)[: known(block)])
                    total = x if total is None else total + x
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([list(total.shape)]), pa.array([_blob(total)], pa.binary())], ["shape", "m"])

        parts = self.table.coalesce(64).mapInArrow(run, "shape array<bigint>, m binary").collect()
        return sum(np.frombuffer(r["m"]).reshape(r["shape"]) for r in parts)

    def largest(self, sign: int) -> np.ndarray:
        """Each column's largest value, or that of its negative."""
        known, width = self._known(), self.width

        @F.pandas_udf("array<double>")
        def top(block: pd.Series, m: pd.Series) -> pd.Series:
            return pd.Series([(sign * np.frombuffer(x).reshape(-1, width)[: known(b)]).max(axis=0) for b, x in zip(block, m, strict=True)])

        each = self.table.select(F.posexplode(top("block", "m")).alias("i", "x")).groupBy("i").agg(F.max("x").alias("x")).collect()  # a row a component
        return np.array([r["x"] for r in sorted(each, key=lambda r: r["i"])])

    def mapped(self, f: Callable[[np.ndarray], np.ndarray], width: int) -> _Tall:
        """The same rows after a function of a block; rows beyond the last stay zeros."""
        known, old = self._known(), self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for block, m in zip(batch.column("block").to_pylist(), batch.column("m").to_pylist(), strict=True):
                    x = np.frombuffer(m).reshape(-1, old)
                    y = np.zeros((len(x), width))
                    y[: known(block)] = f(x[: known(block)])
                    out.append(_blob(y))
                yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(out, pa.binary())], ["block", "m"])

        return _Tall(self.table.mapInArrow(run, "block bigint, m binary"), self.rows, width, self.per_block)

    def orthonormal(self, centre: bool, times: int = 1) -> _Tall:
        """A basis of the columns, less their means if ``centre``, by the inverse root of the Gram matrix, once or twice over."""
        mean = self.sums(lambda m: m.sum(axis=0, keepdims=True)) / self.rows if centre else np.zeros((1, self.width))
        out = self
        for _ in range(times):
            gram = out.sums(lambda m: (m - mean).T @ (m - mean))
            turn = _inverse_root(gram)
            last, out = out, out.mapped(lambda m: (m - mean) @ turn, turn.shape[1])  # noqa: B023
            if last is not self:
                discard(last.table)
            mean = np.zeros((1, out.width))
        return out

    def lines(self) -> DataFrame:
        """``number, v``, numbered from 1."""
        known, width, per_block = self._known(), self.width, self.per_block

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, m in zip(batch.column("block").to_pylist(), batch.column("m").to_pylist(), strict=True):
                    x = np.frombuffer(m).reshape(-1, width)[: known(block)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(x)) + block * per_block + 1), pa.array(list(x), pa.list_(pa.float64()))], ["number", "v"])

        return self.table.mapInArrow(run, "number bigint, v array<double>")


def _tile_times(r: np.ndarray, c: np.ndarray, v: np.ndarray, x: np.ndarray, rows: int, y: np.ndarray | None = None) -> np.ndarray:
    """Cells ``r, c, v`` of a tile times ``x``, added to ``y`` in place: cell by cell if they are few, else as a dense block."""
    y = np.zeros((rows, x.shape[1])) if y is None else y
    if len(v) * 128 > rows * len(x):
        y += np.bincount(r.astype(np.int64) * len(x) + c, v, rows * len(x)).reshape(rows, len(x)) @ x
        return y
    order = np.argsort(r, kind="stable")
    for i in range(0, len(v), 2048):  # so few that what is made of them stays in the cache
        some = order[i : i + 2048]
        at = r[some]
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        y[at[starts]] += np.add.reduceat(v[some, None] * x[c[some]], starts)
    return y


def _each_tile(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """``r, c, v`` of every tile as arrays, the tall block that it meets if there is one, and the columns ``names``."""
    for batch in batches:
        ends = batch.column("r").offsets.to_numpy()
        cells = [batch.column(k).values.to_numpy(zero_copy_only=False) for k in "rcv"]
        m = batch.column("m") if "m" in batch.schema.names else None
        for i, at in enumerate(zip(*[batch.column(k).to_pylist() for k in names], strict=True)):
            yield *[x[ends[i] : ends[i + 1]] for x in cells], None if m is None or not m[i].is_valid else np.frombuffer(m[i].as_buffer()), *at


class _Sums:
    """Tall blocks that a task adds up, given out as batches of 64 MB at most."""

    def __init__(self) -> None:
        self.blocks: dict[int, np.ndarray] = {}

    def of(self, block: int, shape: tuple[int, int]) -> np.ndarray:
        """What a block has so far, to be added to in place."""
        if block not in self.blocks:
            self.blocks[block] = np.zeros(shape)
        return self.blocks[block]

    def add(self, block: int, m: np.ndarray) -> Iterator[pa.RecordBatch]:
        if block in self.blocks:
            self.blocks[block] += m
        else:
            self.blocks[block] = m
        yield from self.full()

    def full(self) -> Iterator[pa.RecordBatch]:
        if len(self.blocks) * next(iter(self.blocks.values())).nbytes > 64 << 20:
            yield from self.all()

    def all(self) -> Iterator[pa.RecordBatch]:
        if self.blocks:
            yield pa.RecordBatch.from_arrays([pa.array(list(self.blocks), pa.int64()), pa.array(map(_blob, self.blocks.values()), pa.binary())], ["block", "m"])
            self.blocks.clear()


def _added(parts: DataFrame) -> DataFrame:
    """The sum of the blobs of each block, added as they come, however many there are."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        line = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([_blob(total)], pa.binary())], ["block", "m"])
        for batch in batches:
            for i, block in enumerate(batch.column("block").to_pylist()):
                m = np.frombuffer(batch.column("m")[i].as_buffer())
                if block == now:
                    total += m
                    continue
                if total is not None:
                    yield line()
                now, total = block, m.copy()
        if total is not None:
            yield line()

    return parts.repartition("block").sortWithinPartitions("block").mapInArrow(add, "block bigint, m binary")


def _product(tiles: DataFrame, other: _Tall | None, inner: str, outer: str, rows: int, width: int, shape: dict[str, int], seed: int = 0) -> _Tall:
    """Tiles of a matrix (or of its transpose: ``inner`` is then ``rb``) times a tall one; without one, a random one.

    ``shape`` tells how many rows (``rb``) and columns (``cb``) a tile has. Each task adds up what its
    tiles give to the same rows before anything is shuffled.
    """
    met = tiles if other is None else tiles.join(other.table.withColumnRenamed("block", inner), inner)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums()
        for r, c, v, m, within, to in _each_tile(batches, inner, outer):
            x = np.random.default_rng([seed, within]).normal(size=(shape[inner], width)) if m is None else m.reshape(-1, width)
            yield from sums.add(to, _tile_times(*((c, r) if inner == "rb" else (r, c)), v, x, shape[outer]))
        yield from sums.all()

    return _Tall(_added(met.mapInArrow(run, "block bigint, m binary")), rows, width, shape[outer])


def _by_strips(tiles: DataFrame, shape: dict[str, int], width: int, rows: _Tall | None = None, columns: _Tall | None = None, back: bool = True, seed: int = 0) -> DataFrame:
    """Blocks ``block, m`` of a product of the tiles, strip by strip of columns, each strip in one task.

    With ``columns``, A times them; without any, A times random ones. With ``rows``, A' times them, and
    with ``back`` then A times that: what is as long as there are columns stays in the task, and its
    inner products come as block -1. A block of ``rows`` goes once to each strip that has cells in it,
    and a strip gives one block for each, so that what is shuffled grows with strips and not with tiles.
    """
    from_rows, from_columns = rows is not None, columns is not None
    at = ["strip", "rb", "cb", "r", "c", "v"]
    none = [F.lit(None).cast(tiles.schema[c].dataType).alias(c) for c in "rcv"]
    work = tiles.select(*at, F.lit(None).cast("binary").alias("m"))
    if from_rows:
        reach = tiles.select("strip", "rb").distinct().join(rows.table.withColumnRenamed("block", "rb"), "rb")
        work = work.union(reach.select("strip", "rb", F.lit(-1).cast("long"), *none, "m"))
    if from_columns:
        per_strip = tiles.select("strip", "cb").distinct().join(columns.table.withColumnRenamed("block", "cb"), "cb")
        work = work.union(per_strip.select("strip", F.lit(-1).cast("long"), "cb", *none, "m"))
    if from_rows or from_columns:  # else the tiles lie by strips as they are
        work = work.repartition("strip").sortWithinPartitions("strip", "rb", "cb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, now, held, tall, near = _Sums(), None, [], {}, None
        gram = np.zeros((width, width))

        def end() -> Iterator[pa.RecordBatch]:
            for cb, z in tall.items() if from_rows else ():
                if back:
                    gram[:] += z.T @ z
                else:
                    yield from sums.add(cb, z)
            for rb, cb, r, c, v in held:
                _tile_times(r, c, v, tall[cb], shape["rb"], sums.of(rb, (shape["rb"], width)))
                yield from sums.full()

        for r, c, v, m, strip, rb, cb in _each_tile(batches, "strip", "rb", "cb"):
            if strip != now:
                yield from end()
                now, held, tall = strip, [], {}
            if m is not None and cb < 0:
                near = m.reshape(-1, width)
            elif m is not None:
                tall[cb] = m.reshape(-1, width).copy()
            elif from_rows:
                tall[cb] = _tile_times(c, r, v, near, shape["cb"], tall.get(cb))
                if back:
                    held.append((rb, cb, r.copy(), c.copy(), v.copy()))
            else:
                if cb not in tall:
                    tall[cb] = np.random.default_rng([seed, cb]).normal(size=(shape["cb"], width))
                _tile_times(r, c, v, tall[cb], shape["rb"], sums.of(rb, (shape["rb"], width)))
                yield from sums.full()
        yield from end()
        yield from sums.all()
        if from_rows and back:
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([_blob(gram)], pa.binary())], ["block", "m"])

    parts = work.select(*at, "m").mapInArrow(run, "block bigint, m binary")
    return _added(parts) if back else parts


def _there_and_back(tiles: DataFrame, basis: _Tall, shape: dict[str, int]) -> _Tall:
    """A times the orthonormal columns of A' times ``basis``; these are made orthonormal afterwards, by their inner products."""
    width = basis.width
    both = materialize(_by_strips(tiles, shape, width, rows=basis), "both")
    turn = _inverse_root(np.frombuffer(both.filter("block = -1").first()["m"]).reshape(width, width))
    raw = _Tall(both.filter("block >= 0"), basis.rows, width, shape["rb"])
    out = raw.mapped(lambda m: m @ turn, turn.shape[1])
    discard(both, raw.table)
    return out


def wide_pca(cells: DataFrame, row: str, column: str, value: str, k: int, over: int = 10, rounds: int = 4, per_block: int = 1024, seed: int = 0, strip_cells: int = 1 << 24, strip_bytes: int = 128 << 20) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Principal components of a long table of cells, however many columns it has: scores (``row, pc``), explained
    variance (``component, ratio``) and loadings (``column, component, loading``).

    Absent cells are zeros. A random range finder of ``k + over`` columns is sharpened by ``rounds`` of
    block power iteration; the table stays as tiles of ``per_block`` rows and up to eight times as many
    columns, columns are centred without filling it in, and the driver holds matrices of ``k + over``
    squared only. Tiles stand in strips of columns, 32 or as many as bring a strip's cells under half of
    ``strip_cells`` and its part of what is as long as there are columns under ``strip_bytes``. Where no
    strip has over ``strip_cells`` cells, an iteration takes the table once, strip by strip; else tile by
    tile, once for each of its products. Each component's largest loading is positive.
    """
    spark = cells.sparkSession
    ship(spark)
    known = cells.select(row, column, F.col(value).cast("double").alias("_v")).filter(F.col(row).isNotNull() & F.col(column).isNotNull() & F.col("_v").isNotNull())
    kept = materialize(known, "cells")
    names = [materialize(numbered(kept.select(F.col(c).alias(f"_{c}")).distinct(), [f"_{c}"]), "names") for c in (row, column)]
    n, p = (x.count() for x in names)
    width = min(k + over, n, p)
    k = min(k, width)
    placed = kept.join(names[0], F.col(row) == F.col(f"_{row}")).withColumnRenamed("_number", "_r").join(names[1], F.col(column) == F.col(f"_{column}")).withColumnRenamed("_number", "_c")
    placed = materialize(placed.select((F.col("_r") - 1).alias("_r"), (F.col("_c") - 1).alias("_c"), "_v"), "placed")
    discard(kept)
    squares = placed.groupBy("_c").agg(F.sum("_v").alias("s"), F.sum(F.col("_v") ** 2).alias("q"), F.count("*").alias("n"))
    strips = squares.groupBy(F.floor(F.col("_c") / per_block)).agg(F.sum(F.col("q") - F.col("s") * F.col("s") / n).alias("q"), F.sum("n").alias("n"))
    strips = materialize(strips.withColumnRenamed(strips.columns[0], "at"), "strips")
    total, most, held = strips.agg(F.sum("q"), F.max("n"), F.sum("n")).first()
    total, most, held = total or 0.0, most or 1, held or 0
    shape = {"rb": per_block, "cb": per_block * max(1, min(8, (1 << 20) // most))}
    cell = F.struct(*[F.pmod(x, F.lit(shape[b])).cast("int").alias(c) for x, b, c in (("_r", "rb", "r"), ("_c", "cb", "c"))], F.col("_v").alias("v"))
    tiles = placed.select(*[F.floor(F.col(x) / shape[b]).alias(b) for x, b in (("_r", "rb"), ("_c", "cb"))], cell.alias("x")).groupBy("rb", "cb").agg(F.collect_list("x").alias("x"))
    many = max(32, p * width * 8 // strip_bytes, 2 * held // max(1, strip_cells))
    wide = max(1, -(-p // (shape["cb"] * many)))  # blocks of columns a strip
    whole = (strips.groupBy(F.floor(F.col("at") * per_block / (shape["cb"] * wide))).agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0) <= strip_cells
    tiles = tiles.select(F.floor(F.col("cb") / wide).alias("strip"), "rb", "cb", F.col("x.r").alias("r"), F.col("x.c").alias("c"), F.col("x.v").alias("v"))
    tiles = materialize(tiles.repartition("strip").sortWithinPartitions("strip", "rb", "cb") if whole else tiles, "tiles")
    discard(placed, strips)
    y = _Tall(_by_strips(tiles, shape, width, seed=seed), n, width, per_block) if whole else _product(tiles, None, "cb", "rb", n, width, shape, seed)
    for _ in range(rounds):
        basis = y.orthonormal(True)
        if whole:
            fresh = _there_and_back(tiles, basis, shape)
        else:
            z = _product(tiles, basis, "rb", "cb", p, basis.width, shape)
            turned = z.orthonormal(False)
            fresh = _product(tiles, turned, "cb", "rb", n, turned.width, shape)
            discard(z.table, turned.table)
        discard(y.table, basis.table)
        y = fresh
    basis = y.orthonormal(True, 2)
    z = _Tall(_by_strips(tiles, shape, basis.width, rows=basis, back=False), p, basis.width, shape["cb"]) if whole else _product(tiles, basis, "rb", "cb", p, basis.width, shape)
    discard(y.table, basis.table)
    values, axes = np.linalg.eigh(z.sums(lambda m: m.T @ m))
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    good = values > 1e-12 * max(total, 1e-300)
    values, axes = values[good], axes[:, good]
    rough = z.mapped(lambda m: m @ (axes / np.sqrt(values)), len(values))
    discard(z.table)
    signs = np.where(rough.largest(1) >= rough.largest(-1), 1.0, -1.0)
    loadings = rough.mapped(lambda m: m * signs, len(values))
    discard(rough.table)
    scores = _Tall(_by_strips(tiles, shape, len(values), columns=loadings), n, len(values), per_block) if whole else _product(tiles, loadings, "cb", "rb", n, len(values), shape)
    mean = scores.sums(lambda m: m.sum(axis=0, keepdims=True)) / n
    centred = scores.mapped(lambda m: m - mean, len(values))
    ratio = spark.createDataFrame([(i + 1, float(v / total)) for i, v in enumerate(values)], "component int, ratio double")
    by_row = names[0].join(centred.lines(), F.col("_number") == F.col("number")).select(F.col(f"_{row}").alias(row), F.col("v").alias("pc"))
    by_column = names[1].join(loadings.lines(), F.col("_number") == F.col("number")).select(F.col(f"_{column}").alias("column"), F.posexplode("v").alias("component", "loading"))
    discard(scores.table, tiles)
    return by_row, ratio, by_column.withColumn("component", F.col("component") + 1)


# -- nearest rows ------------------------------------------------------------------------------------


def _nearest(x: np.ndarray, ids: np.ndarray, q: np.ndarray, asks: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` nearest rows of each query among some; equal distances by id, rows of the query's id apart."""
    found = []
    for ask, v in zip(asks, q, strict=True):
        gap = x - v
        d = np.sqrt((gap * gap).sum(axis=1))
        on = np.flatnonzero(ids != ask)
        best = on[np.lexsort((ids[on], d[on]))[:k]]
        found.append(pd.DataFrame({"query": ask, "id": ids[best], "distance": d[best]}))
    return pd.concat(found) if found else pd.DataFrame({"query": asks[:0], "id": ids[:0], "distance": np.zeros(0)})


def knn_indexed(vectors: DataFrame, queries: DataFrame, k: int, pivots: int = 256, per_block: int = 4096, most_blocks: int = 1 << 17, seed: int = 0) -> DataFrame:
    """The ``k`` nearest other rows of each query, exactly: ``query, id, distance, rank, blocks``.

    Rows belong to their nearest pivot (a random row) and, by their distance to it, to rings of some
    ``per_block`` rows. A query first asks the block nearest to it by the triangle inequality; its
    ``k``-th distance there bounds what can be nearer, and every block that is not provably farther is
    asked as well. ``blocks`` says how many were. Equal vectors stand in the index once, with the
    ``k + 1`` smallest ids, so that copies cost nothing. Blocks are listed for the tasks, at most about
    ``most_blocks`` of them (beyond that blocks grow); queries meet a block in chunks.
    """
    spark = vectors.sparkSession
    ship(spark)
    kind = vectors.schema["id"].dataType.simpleString()
    known = vectors.select("id", F.col("vector").cast("array<double>").alias("vector")).filter("vector is not null")
    salted = known.groupBy("vector", F.pmod(F.xxhash64("id"), F.lit(64)).alias("_salt")).agg(F.slice(F.array_sort(F.collect_set("id")), 1, k + 1).alias("ids"))
    merged = materialize(salted.groupBy("vector").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids")), "merged")
    n = merged.count()
    per_block = max(per_block, -(-n // most_blocks))
    drawn = merged.select("vector").orderBy(F.xxhash64(F.lit(seed), F.to_json("vector"))).limit(max(1, min(pivots, n // 8))).collect()  # a bounded number of rows
    centres = spark.sparkContext.broadcast(np.array([r["vector"] for r in drawn], np.float64))
    near = lambda x: np.sqrt(np.maximum(0, (x * x).sum(axis=1)[:, None] + (centres.value**2).sum(axis=1) - 2 * x @ centres.value.T))

    @F.pandas_udf("struct<pivot:int,gap:double>")
    def home(x: pd.Series) -> pd.DataFrame:
        m = np.array(list(x), np.float64)
        d = near(m) if len(m) else np.zeros((0, 1))
        return pd.DataFrame({"pivot": d.argmin(axis=1).astype(np.int32), "gap": d.min(axis=1, initial=np.inf)})

    homed = materialize(merged.withColumn("_h", home("vector")).select("ids", "vector", "_h.pivot", "_h.gap"), "homed")
    points = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.col("_n") / per_block) - 1)), lambda i: i / F.ceil(F.col("_n") / per_block))
    held = homed.groupBy("pivot").agg(F.count("*").alias("_n"), F.percentile_approx("gap", [i / 1024 for i in range(1, 1024)], 10_000).alias("_q"))
    edges = held.select(F.col("pivot").alias("_p"), F.array_distinct(F.transform(points, lambda s: F.get("_q", F.least(F.lit(1022), F.floor(s * 1024).cast("int"))))).alias("_edges"))
    ringed = homed.join(F.broadcast(edges), F.col("pivot") == F.col("_p")).withColumn("ring", F.size(F.filter("_edges", lambda e: e < F.col("gap")))).drop("_p", "_edges")  # a row a pivot
    sizes = ringed.groupBy("pivot", "ring").agg(F.ceil(F.count("*") / per_block).cast("int").alias("_parts")).withColumnsRenamed({"pivot": "_p", "ring": "_r"})
    split = ringed.join(sizes, (F.col("pivot") == F.col("_p")) & (F.col("ring") == F.col("_r"))).withColumn("part", F.pmod(F.xxhash64(F.get("ids", F.lit(0))), F.col("_parts")).cast("int"))
    rows = materialize(split.select("pivot", "ring", "part", "ids", "vector", "gap"), "blocks")
    listed = rows.groupBy("pivot", "ring", "part").agg(F.min("gap").alias("low"), F.max("gap").alias("high")).orderBy("pivot", "ring", "part").collect()  # some most_blocks rows
    blocks = spark.sparkContext.broadcast(tuple(np.array([r[c] for r in listed]) for c in ("pivot", "ring", "part", "low", "high")))

    def choose(first: bool) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pivot, ring, part, low, high = blocks.value
            for batch in batches:
                x = matrix_of(batch.column("vector"))
                if not len(x) or not len(pivot):
                    continue
                d = near(x)
                for i in range(len(x)):
                    bound = np.maximum(0, np.maximum(d[i, pivot] - high, low - d[i, pivot]))
                    nearest = int(np.lexsort((d[i, pivot], bound))[0])
                    if first:
                        on = np.array([nearest])
                    else:
                        limit = batch.column("limit")[i].as_py()
                        on = np.flatnonzero(bound <= (limit + 1e-6 * (1 + limit) if limit is not None else np.inf))
                        on = on[on != nearest]
                    ids = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(on), np.int32)), batch.column("query").slice(i, 1)).dictionary_decode()
                    lists = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(on), np.int32)), batch.column("vector").slice(i, 1)).dictionary_decode()
                    yield pa.RecordBatch.from_arrays([ids, lists, *(pa.array(a[on].astype(np.int32)) for a in (pivot, ring, part))], ["query", "vector", "pivot", "ring", "part"])

        return run

    def ask(asked: DataFrame) -> DataFrame:
        block = ["pivot", "ring", "part"]
        counted = asked.groupBy(*block).agg(F.ceil(F.count("*") / 4096).cast("int").alias("_chunks")).withColumnsRenamed({c: f"_{c}" for c in block})
        same = [F.col(c) == F.col(f"_{c}") for c in block]
        left = rows.join(counted, same).select(*block, F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)).alias("chunk"), "ids", "vector")
        right = asked.join(counted, same).select(*block, F.pmod(F.xxhash64("query"), F.col("_chunks")).cast("int").alias("chunk"), "query", "vector")

        def compare(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
            times = x["ids"].map(len).to_numpy(int) if len(x) else np.zeros(0, int)
            m = np.repeat(np.array(list(x["vector"]), np.float64).reshape(len(x), -1), times, axis=0)
            ids = np.concatenate([np.asarray(i) for i in x["ids"]]) if len(x) else np.zeros(0)
            return _nearest(m, ids, np.array(list(q["vector"]), np.float64), q["query"].to_numpy(), k) if len(x) and len(q) else _nearest(np.zeros((0, 1)), np.zeros(0), [], np.zeros(0), k)

        keys = [*block, "chunk"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, f"query {kind}, id {kind}, distance double")

    shape = f"query {kind}, vector array<double>, pivot int, ring int, part int"
    asking = queries.select(F.col("id").alias("query"), F.col("vector").cast("array<double>").alias("vector")).filter("vector is not null")
    begun = materialize(ask(asking.mapInArrow(choose(True), shape)), "begun")
    order = Window.partitionBy("query").orderBy("distance", "id")
    limits = begun.withColumn("_k", F.row_number().over(order)).filter(F.col("_k") == k).select("query", F.col("distance").alias("limit"))
    wider = materialize(asking.join(limits, "query", "left").mapInArrow(choose(False), shape), "asked")
    best = begun.union(ask(wider)).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    met = wider.groupBy("query").agg((F.count("*") + 1).alias("blocks"))
    done = materialize(best.join(met, "query", "left").select("query", "id", "distance", "rank", F.coalesce("blocks", F.lit(1)).alias("blocks")), "nearest")
    discard(merged, homed, rows, begun, wider)
    return done


def knn_hamming(profiles: DataFrame, queries: DataFrame, k: int, widths: tuple[int, ...] = (16, 8, 4), per_tile: int = 4096) -> tuple[DataFrame, list[dict]]:
    """The ``k`` nearest other rows of each query by the share of components that differ, and a report of the work.

    Profiles are cut into m pieces; two that differ in fewer than m places share a piece, so that the
    rows that share one hold all within that radius. Pieces get narrower, and the radius grows, for
    queries that have not found ``k`` rows within it. Before each step its candidates are counted;
    where they would outnumber an eighth of all pairs, and at the end, what is left is compared block by block.
    """
    from expatlas.operators.normalize import knn

    kind = profiles.schema["id"].dataType.simpleString()
    known = profiles.select("id", "vector").filter("vector is not null")
    asking = queries.select("id", "vector").filter("vector is not null")
    n, p = known.count(), (known.select(F.max(F.size("vector"))).first()[0] or 0)
    found, report = None, []

    def pieces(df: DataFrame, width: int) -> DataFrame:
        cut = F.transform(F.sequence(F.lit(0), F.lit(-(-p // width) - 1)), lambda i: F.xxhash64(i, F.slice("vector", i * width + 1, width)))
        return df.withColumn("_key", F.explode(cut))

    for width in widths:
        asked = asking.count()
        if not asked or not p:
            break
        keys = [pieces(df, width) for df in (known, asking)]
        counts = [df.groupBy("_key").agg(F.count("*").alias(f"_n{i}")) for i, df in enumerate(keys)]
        pairs = counts[0].join(counts[1], "_key").agg(F.sum(F.col("_n0") * F.col("_n1"))).first()[0] or 0
        radius = -(-p // width) - 1
        report.append({"radius": radius, "queries": asked, "candidates": int(pairs)})
        if pairs > n * asked / 8:
            report[-1]["candidates"] = 0
            break
        right = keys[1].select("_key", F.col("id").alias("query"), F.col("vector").alias("_q"))
        met = keys[0].join(right, "_key").filter("id <> query")
        apart = F.aggregate(F.zip_with("vector", "_q", lambda a, b: (a != b).cast("int")), F.lit(0), lambda s, x: s + x)
        near = met.select("query", "id", apart.alias("_d")).distinct().filter(F.col("_d") <= radius)
        order = Window.partitionBy("query").orderBy("_d", "id")
        near = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        full = near.withColumn("_full", F.max("rank").over(Window.partitionBy("query"))).filter(F.col("_full") == k)
        part = materialize(full.select("query", "id", (F.col("_d") / p).alias("distance"), "rank"), "hamming")
        found = part if found is None else found.union(part)
        asking = materialize(asking.join(part.select(F.col("query").alias("id")).distinct(), "id", "left_anti"), "asking")
    rest = knn(known, asking, k, "hamming", per_tile)
    left = asking.count()
    report.append({"radius": p, "queries": left, "candidates": n * left})
    shape = ["query", "id", "distance", "rank"]
    rest = rest.select(*shape).withColumn("id", F.col("id").cast(kind))
    return (rest if found is None else found.select(*shape).union(rest)), report

"""Embedding near-duplicates by an epsilon grid order join."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from expatlas.llm.components import connected_components
from expatlas.scratch import discard, materialize


def usable(vector: Column) -> Column:
    """Neither null nor zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def principal_axes(nodes: DataFrame, axes: int, sample: int = 4096) -> dict[int, np.ndarray]:
    """Leading principal directions by vector length, fitted on at most ``sample`` vectors in hash order.

    Any orthonormal directions give right bounds; these only skip more.
    """
    rows = nodes.select("vector").orderBy(F.xxhash64("vector")).limit(sample).collect()
    found = {}
    for size in {len(r[0]) for r in rows}:
        x = np.array([r[0] for r in rows if len(r[0]) == size], np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        x -= x.mean(axis=0)  # a direction that all share tells nothing apart
        found[size] = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :axes]
    return found


def _units(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def grid_blocks(nodes: DataFrame, cosine: float, axes: int = 6, per_block: int = 1024) -> DataFrame:
    """Vectors in epsilon grid order, cut into blocks.

    Vectors of a class (label and length) are sorted by their cells, of side epsilon, on the leading
    principal axes. A block holds neighbours in this order and knows the bounds of its places.
    """
    side = math.sqrt(max(0.0, 2 - 2 * cosine))
    directions = principal_axes(nodes, axes)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for size, part in x.groupby(x["vector"].map(len)):
                unit = _units(part["vector"])
                axis = directions.get(size, np.eye(size)[:, :axes])
                at = unit @ axis
                yield pd.DataFrame({"node": part["node"].to_numpy(), "copies": part["copies"].to_numpy(), "label": part["label"].to_numpy(), "size": size,
                                    "cells": list(np.floor(at / side).astype(np.int32)), "at": list(at), "unit": [u.tobytes() for u in unit]})

    placed = nodes.mapInPandas(place, "node long, copies long, label string, size int, cells array<int>, at array<double>, unit binary")
    ordered = placed.repartitionByRange("label", "size", "cells", "node").sortWithinPartitions("label", "size", "cells", "node")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for (label, size), part in x.groupby(["label", "size"], sort=False):
                for begin in range(0, len(part), per_block):
                    p = part.iloc[begin : begin + per_block]
                    at = np.stack(p["at"])
                    yield pd.DataFrame({"label": [label], "size": [size], "first": [int(p["node"].iloc[0])], "low": [at.min(axis=0)], "high": [at.max(axis=0)], "nodes": [p["node"].to_numpy()],
                                        "copies": [p["copies"].to_numpy()], "at": [at.astype(np.float64).tobytes()], "units": [b"".join(p["unit"])]})

    return ordered.mapInPandas(cut, "label string, size int, first long, low array<double>, high array<double>, nodes array<long>, copies array<long>, at binary, units binary")


class _Sequence:
    """An interval of a block in grid order."""

    def __init__(self, nodes, copies, at, units) -> None:
        self.nodes, self.copies, self.at, self.units = nodes, copies, at, units

    def halves(self) -> list:
        h = len(self.nodes) // 2
        return [_Sequence(self.nodes[s], self.copies[s], self.at[s], self.units[s]) for s in (slice(None, h), slice(h, None))]


def _far(a: _Sequence, b: _Sequence, side: float) -> bool:
    gap = np.maximum(0, np.maximum(a.at.min(axis=0) - b.at.max(axis=0), b.at.min(axis=0) - a.at.max(axis=0)))
    return float(gap @ gap) > side * side * (1 + 1e-9) + 1e-12


def _join(a: _Sequence, b: _Sequence, cosine: float, side: float, out: list, leaf: int = 128) -> None:
    """Links between two intervals; those too far apart on the leading axes are skipped."""
    if _far(a, b, side):
        return
    if len(a.nodes) <= leaf and len(b.nodes) <= leaf:
        i, j = np.nonzero(a.units @ b.units.T >= cosine)
        if a is b:
            i, j = i[i < j], j[i < j]
        out.append((a.nodes[i], b.nodes[j], a.copies[i], b.copies[j]))
        return
    if a is b:
        first, second = a.halves()
        for x, y in ((first, first), (first, second), (second, second)):
            _join(x, y, cosine, side, out, leaf)
        return
    for x in a.halves() if len(a.nodes) > leaf else [a]:
        for y in b.halves() if len(b.nodes) > leaf else [b]:
            _join(x, y, cosine, side, out, leaf)


def _summary(links: list) -> pd.DataFrame:
    """For each linked node the copies it is linked with, and one edge of a forest with the same components."""
    a, b, ca, cb = (np.concatenate([x[k] for x in links]) if links else np.zeros(0, np.int64) for k in range(4))
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    counts = np.bincount(i, cb, len(nodes)) + np.bincount(j, ca, len(nodes))
    low = np.arange(len(nodes))
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            break
        low = new
    return pd.DataFrame({"node": nodes, "root": nodes[low] if len(nodes) else nodes, "links": counts.astype(np.int64)})


def block_links(blocks: DataFrame, cosine: float) -> DataFrame:
    """``node, root, links`` from every pair of blocks that may hold a link.

    Blocks stand in stripes of side epsilon along the first axis, each reaching epsilon further, so
    that two blocks within epsilon share the stripe in which the later one begins; they are paired
    there and only there.
    """
    side = math.sqrt(max(0.0, 2 - 2 * cosine))
    slack = side * (1 + 1e-9) + 1e-9

    def stripes(low: Column, high: Column) -> Column:
        return F.sequence(F.floor(low / side), F.floor(high / side))

    bounds = blocks.select("label", "size", "first", "low", "high")
    a = bounds.select("label", "size", F.col("first").alias("a"), F.col("low").alias("la"), F.col("high").alias("ha"), F.explode(stripes(F.col("low")[0], F.col("high")[0] + slack)).alias("stripe"))
    b = a.select("label", "size", "stripe", F.col("a").alias("b"), F.col("la").alias("lb"), F.col("ha").alias("hb"))
    gaps = F.zip_with(F.zip_with("la", "hb", lambda x, y: x - y), F.zip_with("lb", "ha", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    apart = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    pairs = a.join(b, ["label", "size", "stripe"]).filter("a <= b").filter(F.col("stripe") == F.floor(F.greatest(F.col("la")[0], F.col("lb")[0]) / side)).filter(apart <= slack * slack).select("a", "b")
    payload = blocks.select("first", "nodes", "copies", "at", "units")
    one, other = ([F.col(c).alias(f"{c}_{s}") for c in payload.columns] for s in "ab")
    work = pairs.hint("rebalance").join(payload.select(*one), F.col("a") == F.col("first_a")).join(payload.select(*other), F.col("b") == F.col("first_b"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def load(row, s: str) -> _Sequence:
            n = len(row[f"nodes_{s}"])
            return _Sequence(np.asarray(row[f"nodes_{s}"]), np.asarray(row[f"copies_{s}"]), np.frombuffer(row[f"at_{s}"]).reshape(n, -1), np.frombuffer(row[f"units_{s}"]).reshape(n, -1))

        for x in batches:
            for row in x.to_dict("records"):
                found: list = []
                first = load(row, "a")
                _join(first, first if row["a"] == row["b"] else load(row, "b"), cosine, side, found)
                yield _summary(found)

    return work.mapInPandas(run, "node long, root long, links long")


def embedding_duplicates(
    embeddings: DataFrame, cosine: float = 0.93, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", per_block: int = 1024,
) -> DataFrame:
    """Components of vectors of equal label whose cosine is at least ``cosine``, in double precision.

    Returns ``vec_id, n_links, component_id, kept``, a row for each row. Vectors that are null, zero
    or hold null or non-finite components, and those without a label or an id, link with nothing and
    are components of their own. Vectors of different lengths do not link. Equal vectors of a label
    are one node with a number of copies, so that copies are never paired; a task reports sums and a
    spanning forest for its pair of blocks and no list of pairs. Repeated ids count as rows of their
    own. An empty table gives none; other columns are not carried.
    """
    rows = embeddings.select(F.col(vec_id).alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("vector"))
    linkable = usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    nodes = rows.filter(linkable).groupBy("label", "vector").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    blocks = materialize(grid_blocks(nodes, cosine, per_block=per_block), "blocks")
    found = materialize(block_links(blocks, cosine), "found")
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    firsts = linked.join(nodes.select("node", "first_id"), "node").groupBy("root").agg(F.min("first_id").alias("component_id")).hint("rebalance")
    labels = nodes.join(sums, "node", "left").join(linked.join(firsts, "root").select("node", "component_id"), "node", "left")
    labels = labels.select(F.col("label").alias("_label"), F.col("vector").alias("_vector"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "first_id").alias("component_id"))
    labels = materialize(labels, "labels")
    discard(nodes, blocks, found, linked)
    same = linkable & (F.col("label") == F.col("_label")) & (F.col("vector") == F.col("_vector"))
    out = rows.join(labels, same, "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))

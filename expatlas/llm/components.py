"""Connected components of link tables, as rounds of DataFrame joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from expatlas.scratch import discard, materialize


def _mark(edges: DataFrame) -> tuple:
    found = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return found[0], found[1]


def _union(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same for all links of a small table, in one task."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    for b in batches:
        for x, y in zip(b["a"].tolist(), b["b"].tolist(), strict=True):
            low, high = sorted((top(x), top(y)))
            root[high] = low
    nodes = list(root)
    yield pd.DataFrame({"node": nodes, "root": [top(x) for x in nodes]}, dtype="int64")


def spanning(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest of ``n`` nodes that each is linked with, directly or not, by the links ``i, j``."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def connected_components(links: DataFrame, at_once: int = 10_000) -> DataFrame:
    """Smallest node reachable from every linked node: ``node, root``.

    Links are counted first; up to ``at_once`` of them, a megabyte at most, are joined up by one task,
    and more in rounds.

    ``links`` has columns ``a`` and ``b`` (longs); loops are dropped. Large-star steps hang a node's
    larger neighbours on its smallest one, small-star steps its smaller neighbours; the rounds, few
    even for long chains, end when nothing changes. Minima are rebalanced before they are joined, so
    that a node with very many neighbours is split among tasks like any skewed join key. Each step is
    written to the shared folder and deleted after the next one, the result as well; nothing is
    collected but a count and a checksum.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = materialize(edges, "links")
    before = _mark(edges)
    if before[0] <= at_once:
        found = materialize(edges.coalesce(1).mapInPandas(_union, "node long, root long"), "components")
        discard(edges)
        return found
    while before[0]:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low")).hint("rebalance")
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = materialize(large, "large")
        low = large.groupBy("a").agg(F.min("b").alias("low")).hint("rebalance")
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
        last, edges = edges, materialize(small.select("e.a", "e.b").filter("a <> b").distinct(), "small")
        discard(last, large)
        after = _mark(edges)
        if after == before:
            break
        before = after
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    found = materialize(found, "components")
    discard(edges)
    return found

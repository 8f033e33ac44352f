"""Queries without SQL use all components and the sizes of the survey."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from expatlas.plans import registry, science

DIR = "/root/testdata/sf0.001"


def test_pca_uses_all_components(spark):
    rows = spark.read.parquet(f"{DIR}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows], float)
    axes = np.linalg.svd(x - x.mean(0), full_matrices=False)[2][:4]
    got = {r.id: r.pc for r in registry.QUERIES["n14_pca"](spark, DIR).collect()}
    got = np.array([got[r.vec_id] for r in rows])
    assert np.allclose(np.abs(got), np.abs(x @ axes.T), atol=1e-6)
    loadings = {(r.column, r.component): r.loading for r in registry.QUERIES["n14_pca_loadings"](spark, DIR).collect()}
    assert np.allclose([[abs(loadings[(f"c{j}", i + 1)]) for j in range(64)] for i in range(4)], np.abs(axes), atol=1e-6)


def test_pca_of_tied_and_missing_values(spark):
    """Equal eigenvalues, a constant column and nulls; the solver of the first form could fail to converge."""
    rng = np.random.default_rng(3)
    x = np.hstack([np.repeat(np.eye(6), 20, axis=0), np.full((120, 1), 2.0), rng.integers(0, 2, (120, 3))])
    cols = [f"c{i}" for i in range(10)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)] + [(120, *[1.0] * 9, None)], ", ".join(["id int", *[f"{c} double" for c in cols]]))
    scores, ratio, loadings = science.N.pca(df, cols, 10)
    values = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    assert np.allclose([r.ratio for r in ratio.orderBy("component").collect()], values / values.sum(), atol=1e-12)
    axes = np.zeros((10, 10))
    for r in loadings.collect():
        axes[int(r.column[1:]), r.component - 1] = r.loading
    assert np.allclose(axes.T @ axes, np.eye(10)) and np.allclose(axes.T @ np.cov(x.T) @ axes, np.diag(values), atol=1e-12)
    got = {r.id: r.pc for r in scores.collect()}
    assert got[120] is None and np.allclose([got[i] for i in range(120)], x @ axes)


def test_clusters(spark):
    assert registry.QUERIES["m10_kmeans"](spark, DIR).select("cluster").distinct().count() == 15


def test_mixin_curve_and_trees(spark, monkeypatch):
    trees = []
    made = science.M.IsolationForest.__init__
    monkeypatch.setattr(science.M.IsolationForest, "__init__", lambda self, cols, key, trees_=100, *a, **k: (trees.append(trees_), made(self, cols, key, trees_, *a, **k))[1])
    for name in ("m03_isolation_forest", "m04_prop_outliers"):
        registry.QUERIES[name](spark, DIR)
    got = registry.QUERIES["m06_mixin_curve"](spark, DIR).collect()
    assert trees == [100] * 3
    assert sorted((r.source, r.fraction) for r in got) == sorted((s, i / 10) for s in ("N", "R", "price") for i in range(11))


def test_mixtures_score_each_row_once(spark):
    """Rows that no mixture takes are not scored, and those that are, once for all sources and fractions."""
    from expatlas.operators import outliers as M

    asked = spark.sparkContext.accumulator(0)

    class Forest:
        key, seed = "id", 0

        def transform(self, df):
            def far(i):
                asked.add(1)
                return i >= 1000

            return df.withColumn("outlier", F.udf(far, "boolean")("id"))

    base, wide, few = spark.range(100), spark.range(900, 1700), spark.range(2000, 2010)
    fractions = [0.0, 0.3, 0.5, 1.0]
    got = {(r.source, r.fraction): r.outliers for r in M.mixin_curves(Forest(), base, {"wide": wide, "few": few}, fractions).collect()}
    assert {f: got["few", f] for f in fractions} == {f: f for f in fractions}
    hashed = sorted(range(900, 1700), key=lambda i: hashlib.md5(f"0:{i}".encode()).hexdigest())[:100]
    for f in fractions:
        assert got["wide", f] == pytest.approx(sum(i >= 1000 for i in hashed[: int(100 * f)]) / 100)
    assert asked.value == 100 + 100 + 10


def test_scores_equal_a_walk_down_each_tree():
    from expatlas.operators import outliers as M

    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 3))
    x[5, 1] = np.nan
    trees = [M._grow(rng.normal(size=(40, 3)), rng, 6) for _ in range(7)] + [[(-1, 0.5, 0)]]
    forest = [tuple(np.array(c) for c in zip(*t, strict=True)) for t in trees]

    def depth(row, tree):
        at = 0
        while tree[at][0] >= 0:
            at += 1 if row[tree[at][0]] < tree[at][1] else 1 + tree[at][2]
        return tree[at][1]

    want = [-(2 ** (-sum(depth(row, t) for t in trees) / len(trees) / 5.0)) for row in x]
    assert np.allclose(M._scores(x, forest, 5.0), want, rtol=1e-12)
    assert len(M._scores(x[:0], forest, 5.0)) == 0


def test_background_level_reads_all_events(spark, monkeypatch):
    seen = []
    merge = science.R.merge_coverage
    monkeypatch.setattr(science.R, "merge_coverage", lambda track, *a, **k: (seen.append(track), merge(track, *a, **k))[1])
    level = science.R.background_level
    monkeypatch.setattr(science.R, "background_level", lambda cover, genes, sizes: (seen.append(genes), level(cover, genes, sizes))[1])
    assert registry.QUERIES["r16_background_level"](spark, DIR).count() > 0
    events = spark.read.parquet(f"{DIR}/events.parquet")
    assert seen[0].count() == events.count() and seen[1].count() == events.filter("event_id % 2 = 0").count()
    runs = sorted((r.chrom, r["sample"], r.start, r.stop) for r in seen[0].collect())
    assert all(a[:2] != b[:2] or a[3] <= b[2] for a, b in zip(runs, runs[1:]))

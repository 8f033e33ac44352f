"""Coverage sweeps, carried neighbours, covariance, wide components and nearest-row indexes against plain computations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from expatlas.operators import intervals as R
from expatlas.operators import normalize as N
from expatlas.operators import vectors as V


def coverage(rows, how, samples, missing):
    """The aggregate at every place that some sample covers."""
    out = {}
    for chrom in {r[0] for r in rows}:
        for place in range(max(r[2] for r in rows)):
            there = [r[4] for r in rows if r[0] == chrom and r[1] <= place < r[2] and r[4] is not None]
            if not there:
                continue
            v = np.array(there + [0.0] * (samples - len(there)))
            told = {"sum": v.sum, "mean": v.mean, "max": v.max, "median": lambda v=v: np.quantile(v, 0.5), "p75": lambda v=v: np.quantile(v, 0.75), "p95": lambda v=v: np.quantile(v, 0.95)}[how]()
            out[chrom, place] = None if missing == "propagate" and len(there) < samples else float(told)
    return out


@pytest.mark.parametrize("missing", ["zero", "propagate"])
@pytest.mark.parametrize("how", ["sum", "mean", "max", "median", "p75", "p95"])
def test_sweep_by_brute_force(spark, how, missing):
    rng = np.random.default_rng(4)
    rows = []
    for chrom in ("x", "y"):
        for sample in range(4):
            at = 0
            while at < 260:
                at += int(rng.integers(0, 9))
                stop = at + int(rng.integers(1, 30))
                rows.append((chrom, at, stop, f"s{sample}", None if rng.random() < 0.05 else float(rng.integers(-2, 6))))
                at = stop
    df = spark.createDataFrame(rows, "chrom string, start long, stop long, sample string, value double")
    want = coverage(rows, how, 4, missing)
    for tile, most in ((1 << 16, 100_000), (64, 5)):
        got = {}
        for r in R.swept(df, how, 4, missing, tile, most).collect():
            for place in range(r.start, r.stop):
                assert (r.chrom, place) not in got
                got[r.chrom, place] = r.value
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_dense_tile_is_many_groups(spark):
    """A thousand runs of many samples over one stretch: edges times samples of work, no group with all of them."""
    rows = [("c", i % 97 + 10 * (i // 100), i % 97 + 10 * (i // 100) + 300, f"s{i}", 1.0) for i in range(1000)]
    df = spark.createDataFrame(rows, "chrom string, start long, stop long, sample string, value double")
    cut = R._tiled(df, 1 << 10, 200)
    sizes = [r["count"] for r in cut.groupBy("_low").count().collect()]
    assert len(sizes) >= 4 and sum(sizes) > 1000
    got = R.merge_coverage(df, "sum", 1000).collect()
    places = {p: r.value for r in got for p in range(r.start, r.stop)}
    want = np.zeros(800)
    for _, a, b, _, v in rows:
        want[a:b] += v
    assert all(places[p] == want[p] for p in np.flatnonzero(want).tolist()) and len(places) == np.count_nonzero(want)
    assert R.coverage_prevalence(df, 1000).agg(F.max("value")).first()[0] == pytest.approx(want.max() / 1000)


def test_later_run_of_a_sample_cuts_the_earlier(spark):
    df = spark.createDataFrame([("c", 0, 10, "a", 1.0), ("c", 4, 6, "a", 5.0), ("c", 3, 3, "a", 9.0)], "chrom string, start long, stop long, sample string, value double")
    assert sorted(tuple(r)[1:] for r in R.merge_coverage(df, "sum", 1).collect()) == [(0, 4, 1.0), (4, 6, 5.0)]
    empty = df.limit(0)
    assert R.merge_coverage(empty, "sum", 3).count() == 0 and R.coverage_prevalence(empty, 3).count() == 0


def test_neighbours_are_carried_over_tiles(spark):
    rng = np.random.default_rng(5)
    rows = [(str(rng.integers(0, 3)), int(a), int(a + rng.integers(0, 40)), i) for i, a in enumerate(rng.integers(0, 2000, 300))] + [(None, 5, 9, 300), (None, 700, 701, 301)]
    df = spark.createDataFrame(rows, "g string, s long, e long, i long")
    got = {r.i: (r._ended, r._next) for r in R.neighbours(df, ["g"], "s", "e", 16).collect()}
    for g in {r[0] for r in rows}:
        part = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))
        ends = [max([r[2] for r in part[:k]], default=None) for k in range(len(part))]
        for k, r in enumerate(part):
            nxt = part[k + 1][1] if k + 1 < len(part) else None
            if len({(x[1], x[2]) for x in part}) == len(part):
                assert got[r[3]] == (ends[k], nxt)
    assert len(got) == len(rows)
    plan = R.gaps_between(df, "g", "s", "e")._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and all("_tile" in line for line in plan.splitlines() if " Window " in line)


def test_background_is_subtracted_and_clipped(spark):
    df = spark.createDataFrame([("c", 0, 5, 3.0), ("c", 5, 9, 1.0), ("c", 9, 12, None)], "chrom string, start long, stop long, value double")
    assert [r.value for r in R.subtract_clip(df, 1.5).orderBy("start").collect()] == [1.5, 0.0, 0.0]
    around = R.window_around_max(df.filter("value is not null"), 4).first()
    assert (around.start, around.stop) == (0, 4)


def test_gene_quartiles(spark):
    exons = [(g, f"{g}.{t}", 100 * e, 100 * e + 50) for g, n, m in (("a", 1, 2), ("b", 2, 3), ("c", 5, 4)) for t in range(n) for e in range(m)]
    found = R.structure_quartiles(R.feature_structure(spark.createDataFrame(exons, "gene string, transcript string, start long, stop long")))
    got = {r.feature: (r.q1, r["median"], r.q3) for r in found.collect()}
    assert got == {"transcripts": (1.5, 2.0, 3.5), "exons": (2.5, 3.0, 3.5), "introns": (1.5, 2.0, 2.5)}


def test_covariance_by_blocks(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(700, 9)) + 1e6
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)] + [(9000, None)], "id long, vector array<double>").repartition(5)
    got = np.zeros((9, 9))
    for r in V.covariance_rows(df).collect():
        got[r.i, r.j] = r["cov"]
    assert np.allclose(got, np.triu(np.cov(x.T, bias=True)), rtol=1e-8, atol=1e-9)
    shuffled = V.moments(df)._jdf.queryExecution().executedPlan().toString()
    assert shuffled.count("Exchange hashpartitioning(i") == 1 and "Generate" not in shuffled
    c, inverse = V.shrunk_cov(df, 0.1)
    assert np.allclose(c @ inverse, np.eye(9), atol=1e-6)
    assert V.covariance_rows(df.limit(0)).count() == 0


@pytest.mark.parametrize(("n", "p", "k", "per_block"), [(120, 900, 6, 256), (40, 25, 5, 16)])
def test_wide_components(spark, n, p, k, per_block):
    rng = np.random.default_rng(7)
    x = (rng.normal(size=(n, k)) * 3.0 ** np.arange(k, 0, -1)) @ rng.normal(size=(k, p)) + rng.normal(size=(n, p)) * 0.1 + 2
    x[rng.random(x.shape) < 0.1] = 0
    cells = spark.createDataFrame([(f"r{i}", int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x), strict=True)], "sample string, feature long, value double")
    scores, ratio, loadings = V.wide_pca(cells, "sample", "feature", "value", 4, rounds=8, per_block=per_block)
    centred = x - x.mean(axis=0)
    u, s, vt = np.linalg.svd(centred, full_matrices=False)
    got = np.array([r["pc"] for r in sorted(scores.collect(), key=lambda r: int(r["sample"][1:]))])
    axes = np.zeros((p, 4))
    for r in loadings.collect():
        axes[r["column"], r.component - 1] = r.loading
    assert np.allclose(axes.T @ axes, np.eye(4), atol=1e-8)
    assert np.linalg.svd(vt[:4] @ axes)[1].min() > 1 - 1e-6  # one subspace
    assert np.allclose(np.abs(got), np.abs(u[:, :4] * s[:4]), rtol=1e-3, atol=1e-3 * s[0])
    assert np.allclose([r.ratio for r in ratio.orderBy("component").collect()], s[:4] ** 2 / (s**2).sum(), rtol=1e-6)
    assert (axes.max(axis=0) >= -axes.min(axis=0)).all()


def test_wide_components_take_the_cells_once(spark):
    rng, seen = np.random.default_rng(8), spark.sparkContext.accumulator(0)
    x = rng.normal(size=(30, 2)) @ rng.normal(size=(2, 40)) * 5 + rng.normal(size=(30, 40)) * 0.1
    cells = spark.createDataFrame([(int(i), int(j), float(x[i, j])) for i in range(30) for j in range(40)], "sample long, feature long, value double")

    def told(v):
        seen.add(1)
        return v

    counted = cells.withColumn("value", F.udf(told, "double").asNondeterministic()("value"))
    ways = [V.wide_pca(counted, "sample", "feature", "value", 2, rounds=1, per_block=64), V.wide_pca(cells, "sample", "feature", "value", 2, rounds=1, per_block=64, strip_cells=0)]
    assert seen.value == 1200
    strip, tile = ([r["ratio"] for r in ratio.orderBy("component").collect()] for _, ratio, _ in ways)
    s = np.linalg.svd(x - x.mean(axis=0))[1] ** 2
    assert np.allclose(strip, tile, rtol=1e-9) and np.allclose(strip, s[:2] / s.sum(), rtol=1e-6)


def plain_nearest(x, ids, asks, k, distance):
    out = {}
    for q in asks:
        found = sorted((distance(x[i], x[q]), ids[i]) for i in range(len(x)) if ids[i] != ids[q])[:k]
        out[ids[q]] = found
    return out


@pytest.mark.parametrize("per_block", [4096, 16])
def test_nearest_by_rings(spark, per_block):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(150, 4)), rng.normal(size=(150, 4)) + 9, np.repeat(rng.normal(size=(2, 4)), 60, axis=0), np.round(rng.normal(size=(80, 4)))])
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)] + [(9999, None)], "id long, vector array<double>")
    got = V.knn_indexed(df, df.filter("id % 7 = 0"), 5, pivots=12, per_block=per_block).collect()
    want = plain_nearest(x, list(range(len(x))), range(0, len(x), 7), 5, lambda a, b: float(np.sqrt(((a - b) ** 2).sum())))
    for q, found in want.items():
        mine = sorted((r["rank"], r.id, r.distance) for r in got if r.query == q)
        assert [i for _, i, _ in mine] == [i for _, i in found]
        assert [d for _, _, d in mine] == pytest.approx([d for d, _ in found])
    blocks = {r.query: r.blocks for r in got}
    if per_block == 16:
        assert max(blocks.values()) > 1 and np.mean(list(blocks.values())) < 20  # of over thirty
    few = df.filter("id < 3")
    assert V.knn_indexed(few, few, 5).count() == 6 and V.knn_indexed(df.limit(0), df.limit(0), 5).count() == 0


def test_nearest_by_shared_pieces(spark):
    rng = np.random.default_rng(9)
    base = rng.integers(0, 10, (60, 32))
    x = np.repeat(base, 8, axis=0)
    for row in x:
        on = rng.permutation(32)[: rng.integers(0, 5)]
        row[on] = rng.integers(0, 10, len(on))
    df = spark.createDataFrame([(i, r.astype(float).tolist()) for i, r in enumerate(x)], "id long, vector array<double>")
    for asks, k in ((df.filter("id % 5 = 0"), 4), (df.filter("id % 50 = 0"), 9)):
        found, report = V.knn_hamming(df, asks, k, (8, 4, 2))
        got = {}
        for r in found.collect():
            got.setdefault(r.query, []).append((r["rank"], r.id, r.distance))
        want = plain_nearest(x, list(range(len(x))), [r.id for r in asks.collect()], k, lambda a, b: float((a != b).mean()))
        assert {q: [i for _, i, _ in sorted(v)] for q, v in got.items()} == {q: [i for _, i in v] for q, v in want.items()}
        assert report[0]["queries"] == len(want) and report[0]["candidates"] < len(x) * len(want) / 8
    assert report[-1]["queries"] > 0  # nine are not within reach of pieces alone
    same = {(r.query, r["rank"]): r.id for r in N.knn(df, df.filter("id % 50 = 0"), 9, "hamming").collect()}
    assert same == {(q, k): i for q, v in got.items() for k, i, _ in v}


def test_components_by_strips_of_any_width(spark):
    """Cells all over the table, in strips of one tile's columns or of many: the same components, and one block a strip and block of rows."""
    rng = np.random.default_rng(31)
    cells = {(int(i), int(j)): float(v) for i, j, v in zip(rng.integers(0, 40, 900), rng.integers(0, 300, 900), rng.integers(1, 9, 900), strict=True)}
    df = spark.createDataFrame([(f"s{i:02}", j, v) for (i, j), v in cells.items()], "sample string, feature long, value double")
    found = []
    for options in ({}, {"strip_bytes": 1}, {"strip_bytes": 1 << 30, "strip_cells": 600}):
        scores, ratio, _ = V.wide_pca(df, "sample", "feature", "value", 3, rounds=12, per_block=4, **options)
        found.append(([r.ratio for r in ratio.orderBy("component").collect()], np.array([r.pc for r in scores.orderBy("sample").collect()])))
    x = np.zeros((40, 300))
    for (i, j), v in cells.items():
        x[i, j] = v
    values = np.linalg.svd(x - x.mean(axis=0), compute_uv=False) ** 2
    for ratio, scores in found:
        assert np.allclose(ratio, (values / values.sum())[:3]) and np.allclose(scores, found[0][1], atol=1e-4)


def test_shuffles_go_when_a_table_is_written(spark):
    import time

    from expatlas.scratch import materialize

    files = lambda: {str(f) for f in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n").splitlines() if "/shuffle_" in f}
    before = files()
    assert materialize(spark.range(5000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count()).count() == 7
    for _ in range(50):
        if left := [f for f in files() - before if f.endswith(".data")]:
            time.sleep(0.2)
    assert len(left) <= 1  # that of the count itself

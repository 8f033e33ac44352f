"""Label reconciliation, correlations and models against independent computations."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from expatlas.operators import intervals as R
from expatlas.operators import labels as T
from expatlas.operators import normalize as N
from expatlas.operators import outliers as M
from expatlas.plans import registry

DIR = "/root/testdata/sf0.001"


def test_strategy_and_selection(spark):
    rows = [
        ("RNA-Seq", "", "WGS", "WGS|RNA-Seq"), ("EST", "", "RNA-Seq", "EST"), ("WGS", "ChIP-Seq", "RNA-Seq", "ChIP-Seq|RNA-Seq|WGS"), ("OTHER", "EST", "WGS", "EST"),
        ("WGA", None, "WGS", "WGA"), ("other", "RNA-Seq|EST", "EST", "RNA-Seq|EST|OTHER"), ("OTHER", None, "EST", "EST|OTHER"), ("WGS", "EST", "WGS", "WGS"), ("a", "a", "a", "a"),
        (None, None, "WGS", "WGS"), ("WGS", None, None, "WGS"), (None, None, None, None), (None, "EST", None, "EST"),
    ]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "sra string, author string, pred string, want string, i int")
    got = df.select("i", "want", T.reconcile_strategy(F.col("sra"), F.col("author"), F.col("pred")).alias("got")).collect()
    assert [(r.i, r.got) for r in got] == [(r.i, r.want) for r in got]
    pairs = spark.createDataFrame([("ChIP", "ChIP"), ("other", "cDNA"), (None, "PCR"), ("PCR", None)], "sra string, pred string")
    assert [r[0] for r in pairs.select(T.reconcile_selection(F.col("sra"), F.col("pred"))).collect()] == ["ChIP", "cDNA|OTHER", "PCR", "PCR"]


def test_corr_matrix_counts_absent_features_as_zeros(spark):
    counts = {"a": {"g1": 5, "g2": 3, "g3": 1}, "b": {"g1": 5, "g4": 9, "g5": 2, "g6": 1}, "c": {"g2": 4, "g3": 4, "g6": 0}, "d": {"g1": 2, "g2": 2, "g3": 2, "g4": 2, "g5": 2, "g6": 2}}
    table = spark.createDataFrame([(g, f, n) for g, x in counts.items() for f, n in x.items()], "group_id string, feature_id string, count long")
    wide = pd.DataFrame(counts).fillna(0).rank()
    for per_block in (256, 1):
        got = {(r.a, r.b): r["corr"] for r in N.corr_matrix(table, per_block).collect()}
        assert len(got) == 16 and got[("a", "d")] is None
        for p in "abc":
            for q in "abc":
                assert got[(p, q)] == pytest.approx(np.corrcoef(wide[p], wide[q])[0, 1], abs=1e-9)
    assert got[("a", "b")] == pytest.approx(-0.246, abs=1e-3)


def test_median_profile(spark):
    counts = {"i": [5, 3, 0, 7], "j": [4, 0, 1, 9], "k": [0, 8, 8, 1], "x": [1, 2, 3, 4], "y": [4, 3, 2, 1]}
    groups = {"i": "g", "j": "g", "k": "g", "x": "h", "y": "h"}
    table = spark.createDataFrame([(i, f"f{n}", v) for i, vs in counts.items() for n, v in enumerate(vs) if v], "item_id string, feature_id string, count long")
    bridge = spark.createDataFrame([(g, i, 10 + n) for n, (i, g) in enumerate(groups.items())], "group_id string, item_id string, libsize long")
    median = np.median([counts[i] for i in "ijk"], axis=0)
    got = {r.item_id: r["corr"] for r in N.median_corr(table, bridge).collect()}
    assert all(got[i] == pytest.approx(np.corrcoef(counts[i], median)[0, 1]) for i in "ijk")
    flags = {r.item_id: (r.kind, r["drop"]) for r in N.replicate_flags(bridge, table, 0.5).collect()}
    assert flags == {"i": ("multi", False), "j": ("multi", False), "k": ("multi", True), "x": ("pair", True), "y": ("pair", False)}


def test_chisq_p(spark):
    for df, chi2, p in ((1, 3.841458820694124, 0.05), (4, 9.487729036781154, 0.05), (10, 18.307038053275146, 0.05), (2, 0.1, 0.951229424500714), (3, 60.0, 5.8783e-13)):
        assert N._upper_gamma(df / 2, chi2 / 2) == pytest.approx(p, rel=1e-4)
    cells = spark.createDataFrame([("a", "x", 10), ("a", "y", 20), ("b", "x", 30), ("b", "y", 5)], "a string, b string, n long")
    r = N.chisq_test(cells, "a", "b").first()
    want = sum((abs(o - e) - 0.5) ** 2 / e for o, e in ((10, 30 * 40 / 65), (20, 30 * 25 / 65), (30, 35 * 40 / 65), (5, 35 * 25 / 65)))
    assert r.df == 1 and r.chi2 == pytest.approx(want) and r.p == pytest.approx(math.erfc(math.sqrt(want / 2)))


def test_neighbours(spark):
    rows = spark.read.parquet(f"{DIR}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows], float)
    c = np.cov(x.T, bias=True)
    c = 0.9 * c + 0.1 * np.trace(c) / len(c) * np.eye(len(c))
    inverse = np.linalg.inv(c)
    got = {(r.query, r["rank"]): (r.id, r.distance) for r in registry.QUERIES["n16_knn"](spark, DIR).collect()}
    for q in range(0, len(rows), 50):
        gap = x - x[q]
        d = np.sqrt(np.maximum(0, np.einsum("ij,jk,ik->i", gap, inverse, gap)))
        d[q] = np.inf
        assert [got[(rows[q].vec_id, k)][0] for k in range(1, 6)] == [rows[i].vec_id for i in np.argsort(d)[:5]]
    assert len(got) == 5 * len(range(0, len(rows), 50))
    mean = {r.id: r.distance2 for r in registry.QUERIES["n18_mahalanobis_to_mean"](spark, DIR).collect()}
    gap = x - x.mean(axis=0)
    assert np.allclose([mean[r.vec_id] for r in rows], np.einsum("ij,jk,ik->i", gap, inverse, gap))


def test_knn_tiles(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 4, (60, 5)).astype(float)
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, vector array<double>")
    for per_tile in (7, 4096):
        got = sorted((r.query, r["rank"], r.id) for r in N.knn(v, v.filter("id % 3 = 0"), 4, "hamming", per_tile).collect())
        assert got == [(q, k + 1, i) for q in range(0, 60, 3) for k, i in enumerate(sorted((i for i in range(60) if i != q), key=lambda i: ((x[i] != x[q]).mean(), i))[:4])]


def test_outliers_stand_out(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "ab"[i % 2], *(rng.normal(size=2) + 10 * (i % 2)).tolist()) for i in range(600)] + [(1000, "a", 9.0, -9.0), (1001, "b", 25.0, 0.0)]
    df = spark.createDataFrame(rows, "id long, label string, x double, y double")
    got = {r.id: r.score for r in M.outliers_by_group(df, "label", ["x", "y"], "id").collect()}
    assert len(got) == 602 and min(got, key=got.get) in (1000, 1001)
    assert sorted(got, key=got.get)[:2] in ([1000, 1001], [1001, 1000])


def test_models(spark):
    rng = np.random.default_rng(3)
    rows = [(i, ["low", "high"][int(v > 0)], float(v), float(rng.normal())) for i, v in enumerate(rng.normal(size=400))]
    df = spark.createDataFrame(rows, "id long, label string, x double, noise double")
    weights = {r.feature: r.importance for r in M.importances(M.train_classifier(df, ["x", "noise"], "label", 10), ["x", "noise"]).collect()}
    assert weights["x"] > 0.8 and sum(weights.values()) == pytest.approx(1)
    assert M.top_features(spark.createDataFrame(list(weights.items()), "feature string, importance double"), 1).first().feature == "x"
    for penalty in ("l1", "l2"):
        size = {r.feature: r.importance for r in M.svm_weights(M.linear_svm(df, ["x", "noise"], "label", penalty), ["x", "noise"]).collect()}
        assert size["x"] > 5 * size["noise"]
    assert all(r.accuracy > 0.9 for r in M.cross_validate(df, ["x", "noise"], "label", "id", 3, [{"components": 0, "trees": 5}]).collect())
    shares = M.stratified_places(df, "label", "id").filter("_share < 0.8").groupBy("label").count().collect()
    sizes = {r.label: r["count"] for r in df.groupBy("label").count().collect()}
    assert all(abs(r["count"] - 0.8 * sizes[r.label]) <= 1 for r in shares)
    curve = {r.fraction: r.accuracy for r in M.label_noise_curve(df, ["x", "noise"], "label", "id", [0.0, 0.5]).collect()}
    assert curve[0.0] > 0.95 > curve[0.5]
    other = df.withColumn("label", F.when(F.col("id") < 10, "OTHER").otherwise(F.col("label"))).withColumn("predicted", F.lit("low"))
    assert M.relabel_other(other, "label").filter("id < 10 and label <> 'low'").count() == 0
    voted = registry.QUERIES["m08_repeated_votes"](spark, DIR)
    assert {r.status for r in voted.select("status").distinct().collect()} <= {"unanimous", "common", "problem"}


def test_long_runs_cross_tiles(spark):
    rows = [("c", i * 3, i * 3 + 3, float(i // 7 % 2)) for i in range(200)] + [("c", 900, 1500, 1.0), ("d", 0, 5, None), ("d", 5, 9, None)]
    got = sorted((r.chrom, r.start, r.stop, r.value) for r in R.compress(spark.createDataFrame(rows, "chrom string, start long, stop long, value double"), tile=16).filter("chrom = 'c'").collect())
    want = []
    for c, a, b, v in rows[:201]:
        if want and want[-1][2] == a and want[-1][3] == v:
            want[-1] = (c, want[-1][1], b, v)
        else:
            want.append((c, a, b, v))
    assert got == want
    spans = [("c", int(a), int(a + n), f"m{i}") for i, (a, n) in enumerate(zip(np.random.default_rng(4).integers(0, 300, 60), np.random.default_rng(5).integers(0, 90, 60), strict=True))]
    table = spark.createDataFrame(spans, "chrom string, start long, stop long, name string")
    one, many = ({(r.start, r.stop, tuple(r.members)) for r in R.segment(table, ["chrom"], "name", tile).collect()} for tile in (1 << 20, 8))
    assert one == many


def test_reads_in_splits(spark, tmp_path):
    from expatlas.sources import reports as S

    text = "".join(f"@r{i}\nAC{'G' * (i % 50)}\n+\nII{'I' * (i % 50)}\n" for i in range(3000))
    (tmp_path / "SRR7_1.fastq").write_text(text)
    (tmp_path / "SRR8_2.fastq").write_text(text[:-1])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = S.read_reads(spark, str(tmp_path / "*.fastq")).collect()
        import hashlib

        sums = {r.name: r.md5 for r in S.checksum_manifest(spark, str(tmp_path / "*.fastq")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 6000 and all(r.h1 == f"@r{r.read_no}" and len(r.seq) == len(r.qual) == 2 + r.read_no % 50 for r in got)
    assert {(r.item_id, r.mate) for r in got} == {("SRR7", 1), ("SRR8", 2)}
    assert sums == {"SRR7_1.fastq": hashlib.md5(text.encode()).hexdigest(), "SRR8_2.fastq": hashlib.md5(text[:-1].encode()).hexdigest()}


def test_mixtures(spark):
    class Forest:
        key, seed = "id", 0

        def transform(self, df):
            return df.withColumn("outlier", F.col("far"))

    base = spark.range(100).withColumn("far", F.lit(False))
    other = spark.range(1000, 1040).withColumn("far", F.lit(True))
    got = {r.fraction: r.outliers for r in M.mixin_curve(Forest(), base, other, [0.0, 0.25, 0.5, 1.0]).collect()}
    assert got == {0.0: 0.0, 0.25: 0.25, 0.5: 0.5, 1.0: 1.0}

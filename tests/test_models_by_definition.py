"""Repeated votes, forests with draws, split proportions and cross-validation as they are defined, against plain loops."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.feature import PCA, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from expatlas.operators import aggregates as A
from expatlas.operators import normalize as N
from expatlas.operators import outliers as M


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    sure = [(i, "low" if i % 3 else "high", float((i % 3 == 0) * 8 - 4 + rng.normal() * 0.3), float(rng.normal())) for i in range(300)]
    torn = [(1000 + i, ["low", "high"][i % 2], 0.0 + float(rng.normal()) * 0.2, float(rng.normal())) for i in range(20)]
    return spark.createDataFrame(sure + torn, "id long, label string, x double, noise double").cache()


def test_parts_are_stratified_and_differ(rows):
    placed = M.strata(rows, "label", "id", 20, 0.2).select("id", "label", "_drawn").collect()
    drawn = np.array([r._drawn for r in placed])
    for label in ("low", "high"):
        on = np.array([r.label == label for r in placed])
        assert (np.abs(drawn[on].sum(axis=0) - 0.2 * on.sum()) <= 1).all()
    assert len({tuple(c) for c in drawn.T}) == 20 and drawn.any(axis=1).mean() > 0.95
    half = np.array([r._drawn for r in M.strata(rows, "label", "id", 3, 0.5).collect()])
    assert (np.abs(half.sum(axis=0) - 160) <= 2).all()


def test_every_row_has_every_vote(rows):
    model = M.train_repeats(rows, ["x", "noise"], "label", "id", 20, 0.2, 5)
    votes = M.votes_of(model, rows, "id").toPandas()
    assert (votes.groupby("id").size() == 20).all() and len(votes) == 20 * rows.count() and set(votes["model"]) == set(range(20))
    one = model.stages[1].transform(model.stages[0].transform(rows))
    for i in (0, 7, 19):  # the model by itself says the same
        alone = model.stages[2 + i].transform(one).select("id", F.col(f"_p{i}").alias("p")).toPandas().set_index("id")["p"]
        mine = votes[votes["model"] == i].set_index("id")["predicted"]
        assert (alone.map(lambda p: model.stages[0].labels[int(p)]).loc[mine.index] == mine).all()
    told = {r.id: (r.status, r.votes) for r in A.vote_consensus(M.votes_of(model, rows, "id"), "id", "predicted", 20, 15).collect()}
    assert np.mean([told[i][0] == "unanimous" for i in range(300)]) > 0.9
    assert any(told[1000 + i][0] != "unanimous" for i in range(20))
    assert all(s == ("unanimous" if n == 20 else "common" if n >= 15 else "problem") for s, n in told.values())
    others = rows.limit(5).withColumn("id", F.col("id") + 5000).withColumn("label", F.lit("OTHER"))
    both = M.repeated_votes(rows, ["x", "noise"], "label", "id", 3, 0.2, 3, others=others)
    assert both.filter("id >= 5000").count() == 15 and both.filter("predicted is null or predicted = 'OTHER'").count() == 0


def test_draws_with_replacement_and_feature_subsets(spark):
    rng = np.random.default_rng(4)
    cols = [f"c{i}" for i in range(9)]
    data = [(i, "ab"[i % 2], *rng.normal(size=9).tolist()) for i in range(512)] + [(900, "a", 0.0, 0.0, 25.0, *[0.0] * 6), (901, None, *[0.0] * 9), (902, "rare", *[1.0] * 9), (903, "a", *[0.0] * 9)]
    df = spark.createDataFrame(data, "id long, label string, " + ", ".join(f"{c} double" for c in cols))
    forests = M.bootstrap_forests(df, "label", cols, "id")
    told = forests.collect()
    trees = [r for r in told if r.label == "b"]
    assert len(trees) == 100 and all(r.rows == 256 for r in trees)
    assert np.mean([r.distinct / r.rows for r in trees]) == pytest.approx(1 - np.exp(-1), abs=0.02)
    assert all(len(r.used) == 3 for r in told) and len({tuple(r.used) for r in trees}) > 20
    assert all({n["feature"] for n in r.nodes} - {-1} <= {cols.index(c) for c in r.used} for r in told)
    for per_task in (100_000, 40):
        got = {r.id: r.score for r in M.score_by_class(df, forests, "label", cols, "id", per_task).collect()}
        assert len(got) == 515 and got[900] < got[903] - 0.03  # far out in one column, which a third of the trees look at
    one = forests.filter("label = 'a'").orderBy("tree").collect()
    parsed = [(np.array([n["feature"] for n in r.nodes]), np.array([n["cut"] for n in r.nodes]), np.array([n["left"] for n in r.nodes])) for r in one]
    x = np.array([d[2:] for d in data if d[1] == "a"])
    assert np.allclose([got[d[0]] for d in data if d[1] == "a"], M._scores(x, parsed, M._path(one[0].rows)))


def test_rates_of_draws():
    for rate in (1e-6, 0.3, 1.4, 27.0):
        shares = M._draws(rate)
        share = np.diff([0, *shares])
        assert shares[-1] == pytest.approx(1) and (share * np.arange(len(share))).sum() == pytest.approx(rate, rel=1e-6)


def test_forest_grown_on_its_part_scores_all(rows):
    scored = M.split_outliers(rows, ["x", "noise"], "id", trees=20).cache()
    parts = {r.part: r["count"] for r in scored.groupBy("part").count().collect()}
    assert parts["train"] + parts["test"] == 320 and 0.15 < parts["test"] / 320 < 0.35
    forest = M.IsolationForest(["x", "noise"], "id", 20).fit(scored.filter("part = 'train'").select("id", "label", "x", "noise"))
    alone = {r.id: r.score for r in forest.transform(rows).collect()}
    assert all(r.score == pytest.approx(alone[r.id]) for r in scored.collect())
    told = M.split_proportions(scored).toPandas().set_index("part")["outliers"]
    flags = scored.select("part", "outlier").toPandas()
    assert told["all"] == pytest.approx(flags["outlier"].mean()) and told["train"] == pytest.approx(flags[flags["part"] == "train"]["outlier"].mean())


def test_cross_validation_equals_a_loop(rows):
    got = M.cross_validate(rows, ["x", "noise"], "label", "id", [1, 2], [0.001, 1.0], folds=3, repeats=2).collect()
    assert {(r.repeat, r.components, r.cost) for r in got} == {(a, b, c) for a in (0, 1) for b in (1, 2) for c in (0.001, 1.0)}
    placed = M.stratified_places(StringIndexer(inputCol="label", outputCol="_label", stringOrderType="alphabetAsc").fit(rows).transform(rows), "label", "id", 1).withColumn("f", F.col("_place") % 3).cache()
    sizes = placed.groupBy("f", "label").count().toPandas().pivot(index="f", columns="label", values="count")
    assert (sizes.max() - sizes.min() <= 1).all()
    machine = OneVsRest(classifier=LinearSVC(maxIter=10, regParam=1 / (1.0 * 320 * 2 / 3)), labelCol="_label", featuresCol="p", predictionCol="g")
    steps = [VectorAssembler(inputCols=["x", "noise"], outputCol="r"), StandardScaler(inputCol="r", outputCol="s", withMean=True), PCA(k=2, inputCol="s", outputCol="p"), machine]
    scores = []
    for f in range(3):
        said = Pipeline(stages=steps).fit(placed.filter(F.col("f") != f)).transform(placed.filter(F.col("f") == f))
        scores.append(said.agg(F.avg((F.col("g") == F.col("_label")).cast("int"))).first()[0])
    mine = next(r for r in got if (r.repeat, r.components, r.cost) == (1, 2, 1.0))
    assert mine.accuracy == pytest.approx(np.mean(scores), abs=1e-9)


def test_two_best_classes(spark):
    rows = [(1, [0.2, 0.5, 0.3]), (2, [0.4, 0.2, 0.4])]
    got = M.top2_classes(spark.createDataFrame(rows, "id long, probability array<double>"), "id", ["a", "b", "c"]).orderBy("id", "rank").collect()
    assert [tuple(r) for r in got] == [(1, 1, "b", 0.5), (1, 2, "c", 0.3), (2, 1, "a", 0.4), (2, 2, "c", 0.4)]


def test_own_functions_of_normalised_values(spark):
    counts = spark.createDataFrame([("g", "f1", 3), ("g", "f2", 1)], "group_id string, feature_id string, count long")
    plain = {r.feature_id: r.cpm for r in N.cpm(counts).collect()}
    assert {r.feature_id: r.cpm for r in N.cpm(counts, log=lambda c: F.sqrt(c) * 2).collect()} == pytest.approx({k: 2 * v**0.5 for k, v in plain.items()})


def test_bootstrap_cutoff_by_a_loop(spark):
    rng = np.random.default_rng(5)
    data = pd.DataFrame({"item_a": range(500), "item_b": range(1, 501), "corr": rng.beta(9, 1, 500)})
    df = spark.createDataFrame(data)
    numbered = df.withColumn("_b", F.pmod(F.xxhash64("item_a", "item_b"), F.lit(1024))).orderBy("_b", "item_a", "item_b").select("corr").toPandas()["corr"].to_numpy()
    drawn = spark.range(40 * 30).select(F.floor(F.col("id") / 30).alias("d"), F.pmod(F.xxhash64(F.lit(0), "id"), F.lit(500)).alias("i")).toPandas()
    lows = [np.quantile(numbered[part["i"]], 0.05) for _, part in drawn.groupby("d")]
    assert N.bootstrap_cutoff(df, 40, 30).first()[0] == pytest.approx(np.median(lows))

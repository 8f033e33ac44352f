"""Pairs compared block by block agree with the comparison of two lists and with a loop."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from expatlas.operators import normalize as N
from expatlas.operators import pairwise


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    rows = [(f"i{i:02d}", f"f{f:02d}", int(n)) for i in range(24) for f in range(40) if (n := rng.integers(0, 22)) > 0 and rng.random() < 0.5]
    rows += [("i24", f"f{f:02d}", 3) for f in range(40)] + [("i25", "f00", 0)] + [("i26", "x", 11)]
    return spark.createDataFrame(rows, "item_id string, feature_id string, count long").repartition(3).cache()


@pytest.fixture(scope="module")
def bridge(spark):
    return spark.createDataFrame([(i % 3 if i < 27 else None, f"i{i:02d}") for i in range(28)], "group_id int, item_id string")


@pytest.fixture(params=[False, True])
def small(request, monkeypatch):
    """As the sizes are, and blocks and stripes of a few cells."""
    if request.param:
        for name, n in (("CELLS", 60), ("PAIRS", 5), ("SHARED", 7)):
            monkeypatch.setattr(pairwise, name, n)


@pytest.mark.parametrize("threshold", [0, 10, None])
def test_pairs_within_groups(spark, table, bridge, small, threshold):
    from expatlas.operators.relational import pairs_within

    pairs = pairs_within(bridge, "group_id", "item_id").select("item_a", "item_b")
    asked = [lambda p, m=m: N.pair_corr(table, p, m, threshold) for m in ("spearman", "pearson")]
    for ask in asked + ([] if threshold is None else [lambda p: N.sere(table, p, threshold)]):
        want, got = ({(r.item_a, r.item_b): tuple(r[2:]) for r in ask(p).collect()} for p in (pairs, bridge))
        assert set(want) == set(got) and len(got) > 90
        assert all(np.allclose(np.array(got[k], float), np.array(want[k], float), atol=1e-9, equal_nan=True) for k in want)


def test_matrix_and_medians(spark, table, small):
    counts = table.withColumnRenamed("item_id", "group_id")
    wide = counts.toPandas().pivot(index="feature_id", columns="group_id", values="count").fillna(0)
    want = wide.rank().corr()
    got = N.corr_matrix(counts, 5).toPandas().pivot(index="a", columns="b", values="corr")
    assert got.shape == (27, 27) and np.allclose(got, want, equal_nan=True)
    others = want.where(~np.eye(27, dtype=bool))
    cuts = sorted(others.median())  # medians themselves, between them, and where an even number is split by the cut
    for cut in (cuts[9], (cuts[9] + cuts[10]) / 2, float(np.nanmedian(others.iloc[3]))):
        keep = sorted(others.columns[others.round(6).median() > round(cut, 6)])
        found = N.filter_by_median_corr(counts, round(cut, 6), 6, 5).toPandas()
        assert sorted(set(found.a)) == keep and len(found) == len(keep) ** 2
        assert all(abs(x - want.loc[a, b]) < 1e-6 for a, b, x in zip(found["a"], found["b"], found["corr"], strict=True))


def test_nothing_is_sent_a_pair_of_blocks(spark, table, bridge):
    """Pairs of blocks do not pass through a shuffle, which grew with their square."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = N.pair_corr(table, bridge)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" in plan and "Exchange" not in plan


def test_negative_counts_are_refused(spark, bridge):
    rows = spark.createDataFrame([("i00", "a", -1), ("i03", "a", 2)], "item_id string, feature_id string, count long")
    with pytest.raises(ValueError):
        N.pair_corr(rows.withColumn("count", F.col("count")), bridge)


@pytest.mark.parametrize("items", [4, 5])
def test_medians_of_groups_with_many_zeros(spark, items):
    """Also with counts below zero; the zeros of absent items are not written out as lists."""
    rng = np.random.default_rng(items)
    x = rng.integers(-3, 6, (items, 30)) * (rng.random((items, 30)) < np.linspace(0.1, 1, 30))
    rows = spark.createDataFrame([(i, f, int(x[i, f])) for i in range(items) for f in range(30) if x[i, f] or f % 2 or not i], "item_id int, feature_id int, count long")
    got = N.median_corr(rows, spark.createDataFrame([(7, i) for i in range(items)], "group_id int, item_id int"))
    assert "array_repeat" not in got._jdf.queryExecution().analyzed().toString()
    want = [np.corrcoef(v, np.median(x, axis=0))[0, 1] for v in x]
    assert np.allclose([r["corr"] for r in got.orderBy("item_id").collect()], want)

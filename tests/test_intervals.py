"""Golden coordinates of islands, segments and fusions."""

import pytest

from expatlas.operators import intervals as R


def table(spark, rows):
    return spark.createDataFrame([("c", a, b, f"g{i}") for i, (a, b) in enumerate(rows)], "chrom string, start long, stop long, name string")


@pytest.mark.parametrize(("rows", "segments"), [
    ([(1, 10)] * 4, [(1, 10)]),
    ([(1, 10), (5, 20)], [(1, 4), (5, 10), (11, 20)]),
    ([(1, 10), (3, 8)], [(1, 2), (3, 8), (9, 10)]),
    ([(1, 10), (1, 7)], [(1, 7), (8, 10)]),
    ([(1, 10), (5, 10)], [(1, 4), (5, 10)]),
    ([(1, 10), (5, 20), (3, 8)], [(1, 2), (3, 4), (5, 8), (9, 10), (11, 20)]),
])
def test_segments(spark, rows, segments):
    assert sorted((r.start, r.stop) for r in R.segment(table(spark, rows), ["chrom"], "name").collect()) == segments


@pytest.mark.parametrize(("rows", "fusions"), [
    ([(1, 10)] * 4, [(1, 10)]),
    ([(1, 10), (5, 20)], [(1, 20)]),
    ([(1, 20), (5, 10)], [(1, 20)]),
    ([(1, 10), (10, 20)], [(1, 10), (10, 20)]),
    ([(7924323, 7925360), (7923468, 7924491)], [(7923468, 7925360)]),
    ([(1, 200000), (100000, 300000), (400000, 400001)], [(1, 300000), (400000, 400001)]),
])
def test_fusions(spark, rows, fusions):
    assert sorted((r.start, r.stop) for r in R.fuse(table(spark, rows), ["chrom"], "name").collect()) == fusions


def test_members_and_strand(spark):
    rows = spark.createDataFrame([("c", 1, 10, "-", "a"), ("c", 5, 20, "-", "b")], "chrom string, start long, stop long, strand string, name string")
    r = R.fuse(rows, ["chrom"], "name").first()
    assert (r.members, r.strand) == (["a", "b"], "-")
    got = {(s.start, s.stop): s.members for s in R.segment(rows, ["chrom"], "name").collect()}
    assert got == {(1, 4): ["a"], (5, 10): ["a", "b"], (11, 20): ["b"]}


def test_coverage_propagates_missing(spark):
    t = spark.createDataFrame([("c", 0, 10, "a", 1.0), ("c", 5, 10, "b", 3.0)], "chrom string, start long, stop long, sample string, value double")
    assert [tuple(r) for r in R.merge_coverage(t, "mean", 2).orderBy("start").collect()] == [("c", 0, 5, 0.5), ("c", 5, 10, 2.0)]
    assert [r.value for r in R.merge_coverage(t, "mean", 2, missing="propagate").orderBy("start").collect()] == [None, 2.0]


def test_dense_intervals_meet_in_narrow_bins(spark):
    """Rows that meet in a bin are a few times the pairs that overlap, and the pairs are those of brute force."""
    import random

    rng = random.Random(4)
    sides = [[(s, s + rng.choice([0, 1, 3, 9, 40])) for s in (rng.randrange(2000) for _ in range(400))] for _ in range(2)]
    a, b = (table(spark, rows) for rows in sides)
    width = R.bin_for(a, b)
    assert width <= 16 and R.bin_for(a.limit(0), b.limit(0)) == 1
    bins = [{k: sum(s // width <= k <= e // width for s, e in rows) for k in range(2100 // width)} for rows in sides]
    want = sorted((f"g{i}", f"g{j}") for i, (s, e) in enumerate(sides[0]) for j, (t, f) in enumerate(sides[1]) if s < f and t < e)
    assert sum(bins[0][k] * bins[1][k] for k in bins[0]) < 6 * len(want)
    assert sorted((r["name"], r.b_name) for r in R.overlap_join(a, b, ["chrom"]).collect()) == want


def test_tasks_of_feature_structure_grow_with_exons(spark):
    rows = [(f"g{i % 40}", f"t{i % 3}", 10 * i, 10 * i + 5 + i % 2) for i in range(2000)] * 2
    exons = spark.createDataFrame(rows, "gene string, transcript string, start long, stop long")
    found = R.feature_structure(exons, per_task=100)
    assert found.rdd.getNumPartitions() >= len(rows) // 100
    got = {r.gene: (r.transcripts, r.exons, r.introns) for r in found.collect()}
    for g in {r[0] for r in rows}:
        own = sorted({r[1:] for r in rows if r[0] == g})
        introns = {(x[2] + 1, y[1] - 1) for x, y in zip(own, own[1:]) if x[0] == y[0] and y[1] > x[2] + 1}
        assert got[g] == (len({x[0] for x in own}), len({x[1:] for x in own}), len(introns))

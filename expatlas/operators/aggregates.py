"""Roll-ups, summaries, reshaping and windows."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rollup(df: DataFrame, key: str, rules: dict[str, str | Callable[[str], Column]], order: str = "item_id") -> DataFrame:
    """Runs to experiments: a function for each column. ``first`` is the first known value by ``order``, of several the smallest; a sum of nothing is 0."""
    known = {
        "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
        "mean": F.avg,
        "first": lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(order, c))),
        "min": F.min, "max": F.max, "median": F.median, "count": F.count,
    }
    return df.groupBy(key).agg(*[(known[f] if isinstance(f, str) else f)(c).alias(c) for c, f in rules.items()])


def sum_or_zero(df: DataFrame, key: str, col: str, rule: Column, keys: DataFrame) -> DataFrame:
    """Sum over the rows that fulfil a rule, 0 for keys without any."""
    return keys.select(key).distinct().join(df.filter(rule).groupBy(key).agg(F.sum(col).alias(col)), key, "left").fillna(0, [col])


def group_size_hist(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("groups"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n")).withColumn("text", F.format_number("n", 0)).orderBy(F.desc("n"), col)


def summary_stats(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """Least, median, largest and most frequent value (of equals the smallest) of each group, over counts of values."""
    by = by or []
    counts = df.filter(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count("*").alias("_c"))
    rest = counts.groupBy(*by).agg(F.min(col).alias("min"), F.max(col).alias("max"), F.min_by(col, F.struct(-F.col("_c"), col)).alias("mode"))
    median = percentile_columns(df, col, {0.5: "median"}, by)
    joined = rest.join(median, by) if by else rest.join(F.broadcast(median))
    return joined.select(*by, "min", "median", "max", "mode")


def describe(df: DataFrame, col: str) -> DataFrame:
    points = {0.25: "q1", 0.5: "q2", 0.75: "q3"}
    found = percentile_columns(df, col, points)
    rest = df.agg(F.count(col).alias("n"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"), F.min(col).alias("min"), F.max(col).alias("max"))
    return rest.join(F.broadcast(found)).select("n", "mean", "std", "min", *points.values(), "max")


def crosstab(df: DataFrame, a: str, b: str, values: list) -> DataFrame:
    return df.groupBy(a).pivot(b, values).count().fillna(0)


def row_share(df: DataFrame, cols: list[str]) -> DataFrame:
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in cols), F.lit(0))
    return df.withColumns({c: F.try_divide(F.col(c), total) for c in cols})


def majority_column(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Name of each row's largest column, the first of equal ones."""
    best = F.greatest(*cols)
    name = F.coalesce(*[F.when(F.col(c) == best, F.lit(c)) for c in cols])
    return df.select(key, name.alias("majority"))


def positive_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c) > 0).alias(c) for c in cols])


def consistent_within(df: DataFrame, group: str, col: str) -> DataFrame:
    """Groups whose known values all have one sign."""
    return df.groupBy(group).agg((F.count_distinct(F.signum(col)) == 1).alias("consistent"))


def sign_conflicts(df: DataFrame, group: str, col: str) -> DataFrame:
    return df.groupBy(group).agg(F.min(col).alias("low"), F.max(col).alias("high")).filter("low < 0 and high > 0")


def count_summary(counts: DataFrame) -> DataFrame:
    """Total, percent of features seen, number of features, spread."""
    c = F.col("count")
    return counts.groupBy("group_id").agg(F.sum(c).alias("total"), (F.avg((c > 0).cast("int")) * 100).alias("pct_on"), F.count("*").alias("features"), F.log1p(F.stddev_samp(c)).alias("log_std"))


def coverage_tertiles(positions: Column) -> tuple[Column, Column, Column]:
    """Sums of an array of 101 positions over [0,33), [33,68) and [68,101)."""
    return tuple(F.aggregate(F.slice(positions, a + 1, b - a), F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0))) for a, b in ((0, 33), (33, 68), (68, 101)))


def yearly_counts(df: DataFrame, date: str) -> DataFrame:
    """Rows a year with the years between kept, and the running total."""
    years = df.filter(F.col(date).isNotNull()).groupBy(F.year(date).alias("year")).agg(F.count("*").alias("n"))
    spine = years.agg(F.sequence(F.min("year"), F.max("year")).alias("_y")).select(F.explode("_y").alias("year"))
    full = spine.join(years, "year", "left").fillna(0, ["n"])
    return full.withColumn("total", F.sum("n").over(Window.orderBy("year")))


def extremes(df: DataFrame, group: str, item: str, col: str) -> DataFrame:
    """Largest and smallest member of each group; of equal ones the smallest item."""
    return df.groupBy(group).agg(F.min(F.struct((-F.col(col)).alias("v"), F.col(item).alias("i")))["i"].alias("largest"), F.min(F.struct(F.col(col).alias("v"), F.col(item).alias("i")))["i"].alias("smallest"))


def vote_consensus(df: DataFrame, key: str, label: str, n: int, k: int) -> DataFrame:
    """Winner of repeated predictions: unanimous with ``n`` votes, common with at least ``k``, else a problem."""
    votes = df.groupBy(key, label).agg(F.count("*").alias("votes"))
    best = votes.groupBy(key).agg(F.min(F.struct((-F.col("votes")).alias("v"), F.col(label).alias("l"))).alias("b"))
    won = -F.col("b.v")
    return best.select(key, F.col("b.l").alias(label), won.alias("votes"), F.when(won >= n, "unanimous").when(won >= k, "common").otherwise("problem").alias("status"))


def junction_rollup(df: DataFrame) -> DataFrame:
    """Sum and rows for each pair of sites, known where a gene is named, and a label."""
    keys = ["Site1_chr", "Site1_location", "Site2_chr", "Site2_location"]
    out = df.groupBy(*keys).agg(F.sum("count").alias("total"), F.count("*").alias("rows"), (F.max("PrimaryGene").isNotNull()).alias("known"))
    return out.withColumn("label", F.concat(F.col("total").cast("string"), F.lit("("), F.col("rows").cast("string"), F.lit(")")))


def group_apply(df: DataFrame, by: list[str], body: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A caller's function of whole small groups, where no expression says the same; a group must fit a task."""
    return df.groupBy(*by).applyInPandas(body, schema)


def variance_thresholds(components: DataFrame, shares: list[float]) -> DataFrame:
    """Components needed to stay below shares of the variance: ``share, n``."""
    running = running_sum(components, [], [F.desc("ratio"), "component"], F.col("ratio"))
    return running.agg(*[F.count_if(F.col("_sum") < s).alias(f"below_{round(s * 100)}") for s in shares])


def rank_average(df: DataFrame, part: list[str], col: str, out: str = "rank") -> DataFrame:
    """Ranks in which equal values share the mean of their places."""
    ordered = Window.partitionBy(*part).orderBy(col)
    equal = Window.partitionBy(*part, col)
    return df.withColumn(out, F.rank().over(ordered) + (F.count("*").over(equal) - 1) / 2)


def rank_average_ranged(df: DataFrame, part: list[str], col: str, out: str = "rank") -> DataFrame:
    """As ``rank_average``, for few large groups: the values are range-partitioned and their counts summed up."""
    values = df.groupBy(*part, col).agg(F.count("*").alias("_n"))
    before = running_sum(values, part, [col], F.col("_n"))
    ranks = before.select(*part, F.col(col).alias("_v"), (F.col("_sum") - (F.col("_n") - 1) / 2).alias(out))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in part] + [F.col(f"a.{col}").eqNullSafe(F.col("b._v"))]
    joined = df.alias("a").join(ranks.alias("b"), same)
    return joined.select("a.*", f"b.{out}")


def running_sum(df: DataFrame, part: list[str], order: list, value: Column, out: str = "_sum") -> DataFrame:
    """Add the running total of a value in a group's order, without a window over a whole group.

    Rows are range-partitioned and sorted; sums are taken within a partition, and the small table of
    partitions' totals gives the offsets. The sorted rows are written first, so that both see the same.
    """
    from expatlas.scratch import materialize

    by = [*part, *order]
    rows = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumns({"_at": F.monotonically_increasing_id(), "_value": value})
    rows = materialize(rows, "ordered").withColumn("_part", F.shiftright("_at", 33))
    sizes = rows.groupBy(*part, "_part").agg(F.sum("_value").alias("_total"))
    earlier = Window.partitionBy(*part).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*[F.col(c).alias(f"_k_{c}") for c in part], F.col("_part").alias("_p"), F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*part, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = rows.withColumn("_within", F.sum("_value").over(inside))
    joined = own.join(sizes, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in part] + [F.col("_part") == F.col("_p")])
    return joined.select(*df.columns, (F.col("_before") + F.col("_within")).alias(out))


def numbered(df: DataFrame, order: list, out: str = "_number") -> DataFrame:
    """Rows numbered from 1 in sorted order."""
    return running_sum(df, [], order, F.lit(1).cast("long"), out)


def sequence_ids(df: DataFrame, order: list[str], fmt: str, out: str = "id") -> DataFrame:
    """Names numbered in sorted order, without a window over the whole table."""
    return numbered(df, order).select(*df.columns, F.format_string(fmt, F.col("_number")).alias(out))


def exact_percentiles(df: DataFrame, col: str, points: list[float], by: list[str] = ()) -> DataFrame:
    """Percentiles, interpolated, as one row a point and group (``point, value``): values are counted, sorted by
    range and summed up, so that no task holds a group; the rows at the wanted places are picked."""
    by = list(by)
    counted = running_sum(df.filter(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count("*").alias("_n")), by, [col], F.col("_n"))
    n = counted.groupBy(*[F.col(c).alias(f"_g_{c}") for c in by]).agg(F.sum("_n").alias("n"))
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in points])).alias("point")
    places = n.select("*", wanted).filter("n > 0").withColumn("at", F.col("point") * (F.col("n") - 1))
    places = places.withColumn("place", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at"))))).drop("n")
    here = (F.col("place") < F.col("_sum")) & (F.col("place") >= F.col("_sum") - F.col("_n"))
    for c in by:
        here = here & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    met = counted.join(places if by else F.broadcast(places), here)
    low, high = F.min_by(col, "place"), F.max_by(col, "place")
    return met.groupBy(*by, "point").agg((low + (high - low) * (F.first("at") - F.min("place"))).alias("value"))


def percentile_columns(df: DataFrame, col: str, points: dict[float, str], by: list[str] = ()) -> DataFrame:
    """The same, wide: a column a point."""
    found = exact_percentiles(df, col, list(points), by)
    return found.groupBy(*by).agg(*[F.max(F.when(F.col("point") == p, F.col("value"))).alias(n) for p, n in points.items()])


def zscore(df: DataFrame, part: list[str], col: str, out: str = "z") -> DataFrame:
    """Groups' means and deviations are aggregated and joined back, as there may be few, large groups."""
    stats = df.groupBy(*part).agg(F.avg(col).alias("_m"), F.stddev_samp(col).alias("_s")).withColumnsRenamed({c: f"_k_{c}" for c in part})
    joined = df.join(stats, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in part]) if part else df.join(F.broadcast(stats))
    return joined.withColumn(out, F.try_divide(F.col(col) - F.col("_m"), F.col("_s"))).drop("_m", "_s", *[f"_k_{c}" for c in part])

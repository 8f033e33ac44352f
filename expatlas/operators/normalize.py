"""Normalisation, statistics and similarity of long count tables and vectors."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from expatlas.operators.aggregates import running_sum
from expatlas.operators.pairwise import Blocks, pearson, reproducibility, spearman
from expatlas.operators.vectors import moments
from expatlas.scratch import materialize

LOGS = {None: lambda c: c, "log2": lambda c: F.log2(c + 1), "log10": lambda c: F.log10(c + 1), "ln": lambda c: F.log1p(c)}


def _logged(log: str | Callable[[Column], Column] | None, c: Column) -> Column:
    """A value after a named logarithm or any function of the caller's from column to column."""
    return (log if callable(log) else LOGS[log])(c)


def _total(col: str | Column = "count") -> Column:
    return F.sum(col).over(Window.partitionBy("group_id"))


def cpm(counts: DataFrame, scale: float = 1e6, log: str | Callable[[Column], Column] | None = None) -> DataFrame:
    return counts.withColumn("cpm", _logged(log, F.col("count") / _total() * scale))


def rpkm(counts: DataFrame, lengths: DataFrame, scale: float = 1e9, log: str | Callable[[Column], Column] | None = None) -> DataFrame:
    return counts.withColumn("_total", _total()).join(lengths, "feature_id").withColumn("rpkm", _logged(log, F.col("count") * scale / (F.col("_total") * F.col("length")))).drop("_total")


def tpm(counts: DataFrame, lengths: DataFrame, scale: float = 1e6, log: str | Callable[[Column], Column] | None = None) -> DataFrame:
    """Transcripts per million; features without a length go."""
    known = counts.join(lengths.filter("length is not null"), "feature_id").withColumn("_rate", F.col("count") / F.col("length"))
    return known.withColumn("tpm", _logged(log, F.col("_rate") / _total("_rate") * scale)).drop("_rate")


def normalize_all(counts: DataFrame, lengths: DataFrame) -> DataFrame:
    """The three measures in one pass over the joined table."""
    known = counts.withColumn("_total", _total()).join(lengths, "feature_id").withColumn("_rate", F.col("count") / F.col("length"))
    return known.select("group_id", "feature_id", (F.col("count") / F.col("_total") * 1e6).alias("cpm"), (F.col("count") * 1e9 / (F.col("_total") * F.col("length"))).alias("rpkm"), (F.col("_rate") / _total("_rate") * 1e6).alias("tpm"))


def _compare_pairs(counts: DataFrame, pairs: DataFrame, out: str, judge, per_group: int = 64) -> DataFrame:
    """A row for each pair ``item_a, item_b`` out of ``judge(x, y)``, the items' counts side by side by feature.

    An item is one row with its features and counts, sorted, so that items and not features are dealt
    out to pairs; an absent feature counts 0. An item has as many entries as there are features at most.
    An item meets its partners in groups of some ``per_group``, so that it is sent once a group.
    """
    items = counts.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("feature_id", F.col("count").cast("double").alias("count")))).alias("_l"))
    items = items.select("item_id", F.col("_l.feature_id").alias("f"), F.col("_l.count").alias("v"))
    asked = pairs.select("item_a", "item_b")
    groups = asked.groupBy(F.col("item_a").alias("_a")).agg(F.ceil(F.count("*") / per_group).cast("int").alias("_groups"))
    asked = asked.join(groups, F.col("item_a") == F.col("_a")).select("item_a", "item_b", F.pmod(F.xxhash64("item_b"), F.col("_groups")).cast("int").alias("_g"))
    others = asked.join(items.withColumnsRenamed({"item_id": "item_b", "f": "f_b", "v": "v_b"}), "item_b")
    firsts = groups.withColumn("_g", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1))).join(items, F.col("_a") == F.col("item_id")).select(F.col("_a").alias("first"), F.col("_g").alias("part"), F.col("f").alias("f_a"), F.col("v").alias("v_a"))
    names = ["item_a", "item_b", *[c.split()[0] for c in out.split(", ")]]

    def run(first: pd.DataFrame, met: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for own, f_a, v_a in zip(first["first"], first["f_a"], first["v_a"], strict=True):
            for other, f_b, v_b in zip(met["item_b"], met["f_b"], met["v_b"], strict=True):
                at = np.minimum(np.searchsorted(f_a, f_b), len(f_a) - 1)
                shared = f_a[at] == f_b
                y = np.zeros(len(f_a))
                y[at[shared]] = v_b[shared]
                rest = v_b[~shared]
                rows.append((own, other, *judge(np.concatenate([v_a, np.zeros(len(rest))]), np.concatenate([y, rest]))))
        return pd.DataFrame(rows, columns=names)

    kind = asked.schema["item_a"].dataType.simpleString()
    return firsts.groupBy("first", "part").cogroup(others.groupBy("item_a", "_g")).applyInPandas(run, f"item_a {kind}, item_b {kind}, {out}")


def _mean_ranks(x: np.ndarray) -> np.ndarray:
    """Ranks from 1, ties at their mean."""
    _, at, n = np.unique(x, return_inverse=True, return_counts=True)
    return (np.cumsum(n) - (n - 1) / 2)[at]


def _pearson(x: np.ndarray, y: np.ndarray) -> float:
    x, y = x - x.mean() if len(x) else x, y - y.mean() if len(y) else y
    scale = np.sqrt((x @ x) * (y @ y))
    return float(x @ y / scale) if scale > 0 else float("nan")


def pair_corr(counts: DataFrame, pairs: DataFrame, method: str = "spearman", threshold: float | None = 0) -> DataFrame:
    """Correlation of each pair of items over features whose counts sum to more than the threshold.

    ``pairs`` are pairs ``item_a, item_b``, or a bridge ``group_id, item_id``: then all pairs of a group's
    items, the smaller first, compared block by block. Without a threshold it is over all features of
    ``counts``. Null where one of the two does not vary; pairs without such a feature are left out.
    """
    n = counts.select("feature_id").distinct().count() if threshold is None else 0
    if "group_id" in pairs.columns:
        whole = n if threshold is None else None
        return Blocks(counts, "item_id", pairs).pairs(spearman if method == "spearman" else pearson, "corr", _floor(threshold), whole)

    def judge(x: np.ndarray, y: np.ndarray) -> tuple:
        if threshold is None:
            x, y = (np.concatenate([v, np.zeros(n - len(v))]) for v in (x, y))
        else:
            x, y = x[x + y > threshold], y[x + y > threshold]
        return (_pearson(_mean_ranks(x), _mean_ranks(y)) if method == "spearman" else _pearson(x, y)), len(x)

    return _compare_pairs(counts, pairs, "corr double, features bigint", judge).filter("features > 0")


def _floor(threshold: float | None) -> float:
    """What a count must exceed; absent features are zeros, which never do."""
    if threshold is not None and threshold < 0:
        raise ValueError("a threshold must not be negative")
    return threshold or 0.0


def median_corr(counts: DataFrame, bridge: DataFrame) -> DataFrame:
    """Pearson correlation of each item with its group's median profile: ``group_id, item_id, corr``.

    Profiles run over all features of ``counts``; the features that neither an item nor its median has
    enter as a number of zeros.
    """
    rows = counts.select("item_id", "feature_id", F.col("count").cast("double").alias("x")).join(bridge.select("group_id", "item_id"), "item_id")
    sizes = bridge.groupBy("group_id").agg(F.count("*").alias("_items"))
    # zeros of absent items are counted and not written out; where they hold the middle the median is 0
    here = rows.groupBy("group_id", "feature_id").agg(F.count_if(F.col("x") < 0).alias("_below"), F.count_if(F.col("x") > 0).alias("_above"), F.array_sort(F.collect_list(F.when(F.col("x") != 0, F.col("x")))).alias("_v"))
    lists = here.join(sizes, "group_id").filter(F.greatest("_below", "_above") * 2 >= F.col("_items"))
    zeros = (F.col("_items") - F.size("_v")).cast("int")
    at = lambda i: F.when(i < F.col("_below"), F.get("_v", i)).when(i < F.col("_below") + zeros, F.lit(0.0)).otherwise(F.get("_v", i - zeros))
    half = (F.col("_items") / 2).cast("int")
    middle = F.when(F.col("_items") % 2 == 1, at(half)).otherwise((at(half - 1) + at(half)) / 2)
    medians = lists.select("group_id", "feature_id", middle.alias("m")).filter("m <> 0")
    n = counts.agg(F.count_distinct("feature_id").alias("_n"))
    own = rows.groupBy("group_id", "item_id").agg(F.sum("x").alias("sx"), F.sum(F.col("x") * F.col("x")).alias("sxx"))
    of_group = medians.groupBy("group_id").agg(F.sum("m").alias("sm"), F.sum(F.col("m") * F.col("m")).alias("smm"))
    cross = rows.join(medians, ["group_id", "feature_id"]).groupBy("group_id", "item_id").agg(F.sum(F.col("x") * F.col("m")).alias("sxm"))
    both = own.join(of_group, "group_id", "left").join(cross, ["group_id", "item_id"], "left").fillna(0.0, ["sm", "smm", "sxm"]).join(F.broadcast(n))
    cov = F.col("_n") * F.col("sxm") - F.col("sx") * F.col("sm")
    spread = (F.col("_n") * F.col("sxx") - F.col("sx") ** 2) * (F.col("_n") * F.col("smm") - F.col("sm") ** 2)
    return both.select("group_id", "item_id", F.when(spread > 0, cov / F.sqrt(spread)).alias("corr"))


def corr_matrix(counts: DataFrame, per_block: int = 1024, features: int | None = None) -> DataFrame:
    """Spearman correlations of all pairs of groups, long (``a, b, corr``), over all features of the table (or so many as told).

    A group lacks most features, and those are all zeros of one tied rank; only features that two groups
    share are met. Groups come in blocks; a task compares two blocks and writes both triangles, and
    nothing is sent but the blocks, once. Counts must not be negative. Groups of constant counts get null.
    """
    n = counts.select("feature_id").distinct().count() if features is None else features
    return Blocks(counts, "group_id", per_block=per_block).matrix(spearman, n).withColumn("corr", F.nanvl("corr", F.lit(None)))


def sere(counts: DataFrame, pairs: DataFrame, threshold: float = 0) -> DataFrame:
    """Reproducibility of pairs: root of the mean squared deviation from expectation by totals before the filter.

    ``pairs`` as in ``pair_corr``.
    """
    if "group_id" in pairs.columns:
        return Blocks(counts, "item_id", pairs).pairs(reproducibility, "sere", _floor(threshold)).drop("features")

    def judge(x: np.ndarray, y: np.ndarray) -> tuple:
        total, on = x.sum() + y.sum(), x + y > threshold
        share, row = x.sum() / total if total else 0.5, (x + y)[on]
        ex, ey = row * share, row * (1 - share)
        with np.errstate(divide="ignore", invalid="ignore"):
            return float(np.sqrt(((x[on] - ex) ** 2 / ex + (y[on] - ey) ** 2 / ey).sum() / max(len(row), 1))), len(row)

    return _compare_pairs(counts, pairs, "sere double, features bigint", judge).filter("features > 0").drop("features")


def quantile_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Difference of two tracks (chrom, pos, value) after giving both the mean of their sorted values."""

    def ranked(df: DataFrame, name: str) -> DataFrame:
        rows = running_sum(df.select("chrom", "pos", "value"), ["chrom"], ["value", "pos"], F.lit(1).cast("long"), "_rank")
        return rows.select("chrom", F.col("pos").alias(f"pos_{name}"), F.col("value").alias(f"v_{name}"), "_rank")

    paired = ranked(a, "a").join(ranked(b, "b"), ["chrom", "_rank"]).withColumn("_mean", (F.col("v_a") + F.col("v_b")) / 2)
    return paired.select("chrom", F.col("pos_a").alias("pos"), F.col("_mean").alias("_ma")).join(paired.select("chrom", F.col("pos_b").alias("pos"), F.col("_mean").alias("_mb")), ["chrom", "pos"]).select("chrom", "pos", (F.col("_ma") - F.col("_mb")).alias("diff"))


def mergeable_groups(bridge: DataFrame, corr: DataFrame, cutoff: float = 0.95) -> DataFrame:
    """Groups whose lowest pair correlation reaches the cutoff; single items always do."""
    items = bridge.groupBy("group_id").agg(F.count("*").alias("items"))
    low = corr.join(bridge.select(F.col("item_id").alias("item_a"), "group_id"), "item_a").groupBy("group_id").agg(F.min("corr").alias("low"))
    return items.join(low, "group_id", "left").filter((F.col("items") == 1) | (F.col("low") >= cutoff)).select("group_id", "items")


def replicate_flags(bridge: DataFrame, counts: DataFrame, cutoff: float = 0.97) -> DataFrame:
    """Kind of each item's group, and whether to drop the item.

    Of two items that correlate below the cutoff the smaller goes; of more, those that do so with the
    group's median profile.
    """
    counts = materialize(counts.select("item_id", "feature_id", "count"), "counts")
    sizes = bridge.withColumn("items", F.count("*").over(Window.partitionBy("group_id")))
    of_two = sizes.filter("items = 2").groupBy("group_id").agg(F.min("item_id").alias("item_a"), F.max("item_id").alias("item_b"))
    pairs = sizes.filter("items = 2").select("group_id", "item_id")
    two = pair_corr(counts, pairs, "pearson", None).join(of_two, ["item_a", "item_b"]).select("group_id", F.explode(F.array("item_a", "item_b")).alias("item_id"), "corr")
    many = median_corr(counts, sizes.filter("items > 2"))
    rows = sizes.join(two.union(many), ["group_id", "item_id"], "left").withColumn("_rank", F.row_number().over(Window.partitionBy("group_id").orderBy(F.desc("libsize"), "item_id")))
    kind = F.when(F.col("items") == 1, "singleton").when(F.col("items") == 2, "pair").otherwise("multi")
    bad = F.coalesce((F.col("corr") < cutoff) & ~F.isnan("corr"), F.lit(False))
    drop = F.when(F.col("items") == 2, bad & (F.col("_rank") > 1)).otherwise(bad)
    return rows.select("group_id", "item_id", kind.alias("kind"), drop.alias("drop"))


def bootstrap_cutoff(pairs: DataFrame, draws: int = 1000, size: int = 100, alpha: float = 0.95, seed: int = 0) -> DataFrame:
    """Median over draws of the (1 - alpha) point of correlations of randomly drawn pairs.

    Pairs are numbered within hash buckets, whose offsets are one small table; every draw looks up
    ``size`` random numbers, an equi-join of draws * size rows.
    """
    bucket = F.pmod(F.xxhash64("item_a", "item_b"), F.lit(1024))
    hashed = pairs.select("item_a", "item_b", "corr", bucket.alias("_b"))
    sizes = {r[0]: r[1] for r in hashed.groupBy("_b").count().collect()}  # 1,024 numbers at most
    n, first, total = sum(sizes.values()), [], 0
    for b in range(1024):
        first.append(total)
        total += sizes.get(b, 0)
    place = F.get(F.array(*[F.lit(x) for x in first]), F.col("_b").cast("int"))
    numbered = hashed.select((place + F.row_number().over(Window.partitionBy("_b").orderBy("item_a", "item_b")) - 1).cast("long").alias("_i"), "corr")
    wanted = pairs.sparkSession.range(draws * size).select(F.floor(F.col("id") / size).alias("draw"), F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(n, 1))).alias("_i"))
    return wanted.join(numbered, "_i").groupBy("draw").agg(F.percentile("corr", F.lit(1 - alpha)).alias("low")).agg(F.median("low").alias("cutoff"))


def chisq_posthoc(cells: DataFrame, a: str, b: str, n: str = "n", two_sided: bool = False, alpha: float = 0.05) -> DataFrame:
    """Expected counts, residuals, adjusted residuals, cell X2, p, Benjamini-Hochberg q and flag of a long cross-tab.

    ``residual`` is observed less expected, ``p`` the normal density of the adjusted residual (or
    twice that), and ``flag`` is set where q is at most ``alpha``. A cross-tab has a row for each pair
    of values of two labels, so that its windows stay small.
    """
    none = Window.partitionBy()
    t, ra, rb = F.sum(n).over(none), F.sum(n).over(Window.partitionBy(a)), F.sum(n).over(Window.partitionBy(b))
    x = cells.withColumns({"_t": t, "_a": ra, "_b": rb}).withColumn("expected", F.col("_a") * F.col("_b") / F.col("_t"))
    x = x.withColumn("residual", F.col(n) - F.col("expected"))
    x = x.withColumn("adjusted", F.col("residual") / F.sqrt(F.col("expected") * (1 - F.col("_a") / F.col("_t")) * (1 - F.col("_b") / F.col("_t"))))
    density = F.exp(-F.col("adjusted") ** 2 / 2) / F.sqrt(F.lit(2 * np.pi))
    x = x.withColumn("x2", F.col("residual") ** 2 / F.col("expected")).withColumn("p", F.least(F.lit(1.0), density * 2) if two_sided else density)
    rank = F.row_number().over(Window.orderBy("p", a, b))
    x = x.withColumn("_r", rank).withColumn("_m", F.count("*").over(none))
    q = F.min(F.least(F.lit(1.0), F.col("p") * F.col("_m") / F.col("_r"))).over(Window.orderBy(F.desc("_r")))
    return x.withColumn("q", q).withColumn("flag", F.col("q") <= alpha).drop("_t", "_a", "_b", "_r", "_m")


def _upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function: a series below a + 1, a continued fraction above."""
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1 - total * scale)
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h, i = d, 0
    while True:
        i += 1
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b or tiny)
        c = b + step / c or tiny
        h *= c * d
        if abs(c * d - 1) < 1e-15 or i > 10_000:
            return scale * h


def chisq_test(cells: DataFrame, a: str, b: str, n: str = "n") -> DataFrame:
    """One row ``chi2, p, df`` for a whole cross-tab; a table of two by two is corrected for continuity."""
    x = chisq_posthoc(cells, a, b, n)
    plain = F.sum(F.col("residual") ** 2 / F.col("expected"))
    corrected = F.sum(F.greatest(F.abs("residual") - 0.5, F.lit(0.0)) ** 2 / F.col("expected"))
    df = ((F.count_distinct(a) - 1) * (F.count_distinct(b) - 1)).alias("df")
    row = x.agg(df, plain.alias("plain"), corrected.alias("corrected")).select("df", F.when(F.col("df") == 1, F.col("corrected")).otherwise(F.col("plain")).alias("chi2"))
    found = row.first()
    p = 1.0 if not found["df"] else _upper_gamma(found["df"] / 2, found["chi2"] / 2)
    return row.select("chi2", F.lit(p).alias("p"), "df")


def standard_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean 0 and population deviation 1; constant columns are only centred."""
    stats = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    scaled = df.join(F.broadcast(stats))
    return scaled.select(*[((F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") == 0, 1.0).otherwise(F.col(f"_s_{c}"))).alias(c) if c in cols else F.col(c) for c in df.columns])


def pca(df: DataFrame, cols: list[str], k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scores (``pc``), explained variance (``component, ratio``) and loadings (``column, component, loading``).

    The tasks sum up the covariance (``moments``); its eigenvectors, p x p numbers, are found on the driver
    by a symmetric solver, which always converges. Rows with a null take no part and have null scores.
    """
    spark = df.sparkSession
    vector = F.array(*[F.col(c).cast("double") for c in cols])
    known = ~F.exists(vector, lambda x: x.isNull())
    lines = moments(df.select(vector.alias("vector"))).select("i", "line").collect()  # a line a column
    cov = np.array([r["line"] for r in sorted(lines, key=lambda r: r["i"])]).reshape(-1, len(cols)) if lines else np.zeros((len(cols), len(cols)))
    values, axes = np.linalg.eigh((cov + cov.T) / 2)
    values, axes = np.maximum(values[::-1], 0), axes[:, ::-1][:, :k]
    share = values / (values.sum() or 1.0)
    ratio = spark.createDataFrame([(i + 1, float(r)) for i, r in enumerate(share[:k])], "component int, ratio double")
    loadings = spark.createDataFrame([(c, i + 1, float(axes[j, i])) for j, c in enumerate(cols) for i in range(axes.shape[1])], "column string, component int, loading double")

    @F.pandas_udf("array<double>")
    def turned(x: pd.Series) -> pd.Series:
        out = [None if v is None else np.asarray(v, np.float64) @ axes for v in x]
        return pd.Series(out, dtype=object)

    return df.withColumn("pc", turned(F.when(known, vector))), ratio, loadings


def binned_profiles(vectors: DataFrame, bins: int) -> DataFrame:
    """Each component's equal-width bin, from 0, between its least and largest value; constant components are all 0."""
    ends = vectors.select(F.posexplode("vector").alias("i", "x")).groupBy("i").agg(F.min("x").alias("a"), F.max("x").alias("b"))
    ends = ends.agg(F.array_sort(F.collect_list(F.struct("i", "a", "b"))).alias("_ends"))  # one entry a component
    share = lambda x, e: F.when(e["b"] > e["a"], F.least(F.lit(bins - 1), F.floor((x - e["a"]) / (e["b"] - e["a"]) * bins))).otherwise(0)
    return vectors.join(F.broadcast(ends)).withColumn("vector", F.zip_with("vector", "_ends", lambda x, e: share(x, e).cast("double"))).drop("_ends")


def knn(vectors: DataFrame, queries: DataFrame, k: int, metric: str = "euclidean", per_tile: int = 4096) -> DataFrame:
    """The ``k`` nearest other rows of each query: ``query, id, distance, rank``.

    Rows and queries are dealt into shares of about ``per_tile`` and meet tile by tile, each tile giving
    its own best ``k``; no side is broadcast, whatever its size.
    """
    shares = [max(1, -(-df.count() // per_tile)) for df in (vectors, queries)]
    home = [F.pmod(F.xxhash64("id"), F.lit(n)).cast("int") for n in shares]
    rows = vectors.select("id", "vector", home[0].alias("r"), F.explode(F.sequence(F.lit(0), F.lit(shares[1] - 1))).alias("c"))
    asks = queries.select("id", "vector", F.explode(F.sequence(F.lit(0), F.lit(shares[0] - 1))).alias("r"), home[1].alias("c"))

    def nearest(_: tuple, x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(x) and len(q):
            m, ids = np.array(list(x["vector"]), np.float64), x["id"].to_numpy()
            for query, v in zip(q["id"], q["vector"], strict=True):
                gap = m - np.asarray(v, np.float64)
                d = np.sqrt((gap * gap).sum(axis=1)) if metric == "euclidean" else (gap != 0).mean(axis=1)
                on = np.flatnonzero(ids != query)
                best = on[np.lexsort((ids[on], d[on]))[:k]]
                found.append(pd.DataFrame({"query": query, "id": ids[best], "distance": d[best]}))
        return pd.concat(found) if found else pd.DataFrame({"query": [], "id": [], "distance": []})

    kind = vectors.schema["id"].dataType.simpleString()
    met = rows.groupBy("r", "c").cogroup(asks.groupBy("r", "c")).applyInPandas(nearest, f"query {kind}, id {kind}, distance double")
    best = Window.partitionBy("query").orderBy("distance", "id")
    return met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(label, pred).agg(F.count("*").alias("n"))


def classification_summary(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Accuracy and precision weighted by label frequency."""
    c = confusion(df, label, pred)
    right = c.filter(F.col(label) == F.col(pred)).select(F.col(label).alias("k"), F.col("n").alias("tp"))
    labels = c.groupBy(F.col(label).alias("k")).agg(F.sum("n").alias("actual"))
    preds = c.groupBy(F.col(pred).alias("k")).agg(F.sum("n").alias("said"))
    rows = labels.join(preds, "k", "left").join(right, "k", "left").fillna(0, ["tp", "said"])
    precision = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("said").cast("double")), F.lit(0.0))
    return rows.agg((F.sum("tp") / F.sum("actual")).alias("accuracy"), (F.sum(precision * F.col("actual")) / F.sum("actual")).alias("weighted_precision"))


def filter_by_median_corr(counts: DataFrame, cut: float = 0.6, digits: int | None = None, per_block: int = 1024) -> DataFrame:
    """Spearman correlations (rounded, if asked) of pairs of groups whose median correlation to the others is above the cut.

    Medians are told from counts that the tasks report; the matrix is made of the groups that stay, over
    all features of the table.
    """
    cells = materialize(counts.select("group_id", "feature_id", "count"), "counts")
    n = cells.select("feature_id").distinct().count()
    judge = spearman if digits is None else lambda m: np.round(spearman(m), digits) + 0.0
    good = materialize(Blocks(cells, "group_id", per_block=per_block).medians_above(judge, n, cut), "good")
    kept = corr_matrix(cells.join(good, F.col("group_id") == F.col("a"), "left_semi"), per_block, n)
    return kept if digits is None else kept.withColumn("corr", F.round("corr", digits) + 0.0)


def silhouette_sweep(vectors: DataFrame, ks: list[int], seed: int = 0) -> DataFrame:
    rows = vectors.select("id", array_to_vector("vector").alias("features")).persist()
    judge = ClusteringEvaluator()
    scores = [(k, float(judge.evaluate(KMeans(k=k, seed=seed).fit(rows).transform(rows)))) for k in ks]
    rows.unpersist()
    return vectors.sparkSession.createDataFrame(scores, "k int, silhouette double")


def kmeans(vectors: DataFrame, k: int, seed: int = 0) -> DataFrame:
    rows = vectors.select("id", array_to_vector("vector").alias("features"))
    return KMeans(k=k, seed=seed, predictionCol="cluster").fit(rows).transform(rows).select("id", "cluster")


def norm_medians(counts: DataFrame, category: DataFrame, categories: list) -> DataFrame:
    """Median log CPM of each feature by category of its group, wide, 0 where a category is absent."""
    rows = cpm(counts, log="log2").join(category, "group_id")
    return rows.groupBy("feature_id").pivot("category", categories).agg(F.median("cpm")).fillna(0)

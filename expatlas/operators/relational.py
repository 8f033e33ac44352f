"""Filters, projections, joins, set algebra, sorting and sampling of catalogue tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# -- filters and projections ------------------------------------------------------------------


def keep_rows(df: DataFrame, col: str, values: list | None) -> DataFrame:
    """Rows whose value is listed; None keeps all."""
    return df if values is None else df.filter(F.col(col).isin(values))


def remove_rows(df: DataFrame, col: str, values: list | None) -> DataFrame:
    """Rows whose value is not listed (nulls stay); None keeps all."""
    return df if values is None else df.filter(~F.coalesce(F.col(col).isin(values), F.lit(False)))


def unwind(df: DataFrame, path: str, out: str | None = None) -> DataFrame:
    """One row for each element of an array; rows without elements go."""
    return df.withColumn(out or path, F.explode(path))


def build_bridge(catalog: DataFrame, min_spots: int = 100_000) -> DataFrame:
    """Runs of experiments with more than ``min_spots`` spots: ``srx, srr, libsize``."""
    runs = unwind(catalog.select("srx", "runs"), "runs", "run")
    spots = F.expr("try_cast(run.nspots AS BIGINT)")
    return runs.select("srx", F.col("run.srr").alias("srr"), spots.alias("libsize")).filter(F.col("libsize") > min_spots).orderBy("srx", "srr")


def clean_number(col: Column) -> Column:
    """A number from text; empty text and null are 0."""
    text = F.trim(col.cast("string"))
    return F.when(text.isNull() | (text == ""), F.lit(0.0)).otherwise(text.try_cast("double"))


def too_few_reads(counts: list[Column], most: int = 1000) -> Column:
    """Some known count is above 0 and none above ``most``."""
    known = [F.coalesce(c, F.lit(0)) for c in counts]
    return reduce(lambda a, b: a | b, [c > 0 for c in known]) & reduce(lambda a, b: a & b, [c <= most for c in known])


def too_short_reads(lengths: list[Column], least: float = 25) -> Column:
    known = [F.coalesce(c, F.lit(0)) for c in lengths]
    return reduce(lambda a, b: a | b, [c > 0 for c in known]) & reduce(lambda a, b: a & b, [c < least for c in known])


def flags_from_array(df: DataFrame, array: str, names: list[str]) -> DataFrame:
    return df.withColumns({n: F.coalesce(F.array_contains(array, n), F.lit(False)).cast("int") for n in names})


def rename_cols(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    return df.withColumnsRenamed({c: rule(c) for c in df.columns})


def to_percent(df: DataFrame, prefix: str = "pct_") -> DataFrame:
    return df.withColumns({c: F.col(c) * 100 for c in df.columns if c.startswith(prefix)})


def greatest_of(df: DataFrame, cols: list[str], out: str) -> DataFrame:
    """Largest of the columns, skipping nulls."""
    return df.withColumn(out, F.greatest(*cols) if len(cols) > 1 else F.col(cols[0]))


def effective_libsize(layout: Column, r1: Column, r2: Column) -> Column:
    return F.when(layout.isin("SE", "keep_R1"), r1).when(layout == "keep_R2", r2).when(layout == "PE", F.greatest(r1, r2))


def canon_layout(layout: Column) -> Column:
    return F.when(layout.isin("keep_R1", "keep_R2"), "PE->SE").otherwise(layout)


def qc_libsize(df: DataFrame, cols: list[str], key: list[str], least: float = 100_000) -> DataFrame:
    """Keys whose largest library size is at least ``least``."""
    return greatest_of(df, cols, "_size").filter(F.col("_size") >= least).select(*key)


def qc_readlen(df: DataFrame, cols: list[str], key: list[str], least: float = 30) -> DataFrame:
    return qc_libsize(df, cols, key, least)


def qc_mappability(single: DataFrame, paired: DataFrame, key: list[str], most: float = 0.5) -> DataFrame:
    """Keys with at most this share of unaligned reads, of both layouts; rows with nulls go."""
    branches = [d.dropna().filter((F.col("reads") > 0) & (F.col("unaligned") / F.col("reads") <= most)).select(*key) for d in (single, paired)]
    return branches[0].unionByName(branches[1])


def qc_contamination(screen: DataFrame, key: list[str], reference: str = "dm6", cutoff: float = 50) -> DataFrame:
    """Keys of which the reference's share is at least the cutoff."""
    share = F.max(F.when(F.col("reference") == reference, F.col("percent")))
    return screen.groupBy(*key).agg(share.alias("percent")).filter(F.col("percent") >= cutoff)


def strand_label(first: Column, second: Column, cutoff: float = 0.75) -> Column:
    """The first strand wins where both reach the cutoff."""
    return F.when(first >= cutoff, "first").when(second >= cutoff, "second").otherwise("unstranded")


def strand_indicator(share: Column, weak: float = 0.75, strong: float = 0.95) -> Column:
    """-2 .. 2 by the share of reads on the first strand; stronger classes win."""
    return F.when(share >= strong, 2).when(share <= 1 - strong, -2).when(share >= weak, 1).when(share <= 1 - weak, -1).otherwise(0)


def strand_counts(df: DataFrame, col: str, t: float = 75) -> DataFrame:
    c = F.col(col)
    return df.agg(F.count_if(c >= t).alias("first"), F.count_if((c < t) & (c > 100 - t)).alias("unstranded"), F.count_if(c <= 100 - t).alias("second"))


def contaminant_flags(df: DataFrame, cutoffs: dict[str, float]) -> DataFrame:
    return df.withColumns({f"flag_{c}": F.coalesce(F.col(c) >= v, F.lit(False)) for c, v in cutoffs.items()})


def any_contaminant(cols: list[str], cutoff: float = 1.0) -> Column:
    return F.coalesce(F.greatest(*cols) >= cutoff, F.lit(False))


def flag_below(df: DataFrame, col: str, cut: float, out: str) -> DataFrame:
    return df.withColumn(out, F.coalesce(F.col(col) < cut, F.lit(False)))


def length_class(length: Column) -> Column:
    return F.when(length < 25, "under_25").when(length < 45, "under_45").when(length < 160, "under_160").when(length < 300, "under_300").when(length >= 300, "from_300")


def gate(df: DataFrame, rule: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that fulfil a rule, and the others (unknown counts as not fulfilled)."""
    ok = F.coalesce(rule, F.lit(False))
    return df.filter(ok), df.filter(~ok)


def percentile_gate(df: DataFrame, positive: list[str], negative: list[str], q: float = 0.5) -> DataFrame:
    """Rows not below the percentile in any positive metric and not above it in any negative one."""
    from expatlas.operators.aggregates import percentile_columns

    cuts = reduce(lambda a, b: a.join(F.broadcast(b)), [percentile_columns(df, c, {q: f"_cut_{c}"}) for c in [*positive, *negative]])  # one row each
    rules = [F.col(c) >= F.col(f"_cut_{c}") for c in positive] + [F.col(c) <= F.col(f"_cut_{c}") for c in negative]
    return df.join(F.broadcast(cuts)).filter(reduce(lambda a, b: a & b, rules)).select(*df.columns)


def filter_junctions(df: DataFrame, main: list[str], least: int = 500) -> DataFrame:
    """Both sites on one main chromosome, or far apart in a named gene."""
    same = (F.col("Site1_chr") == F.col("Site2_chr")) & F.col("Site1_chr").isin(main)
    return df.filter(same | ((F.abs(F.col("Site2_location") - F.col("Site1_location")) > least) & F.col("PrimaryGene").isNotNull()))


def fill_mean(df: DataFrame, cols: list[str]) -> DataFrame:
    means = df.agg(*[F.avg(c).alias(f"_mean_{c}") for c in cols])
    return df.join(F.broadcast(means)).select(*[F.coalesce(c, f"_mean_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])


def collapse_rare(df: DataFrame, col: str, n: int = 50, other: str = "OTHER") -> DataFrame:
    """Classes of fewer than ``n`` rows become ``other``."""
    common = df.groupBy(F.col(col).alias("_class")).count().filter(F.col("count") >= n).select("_class", F.lit(True).alias("_common"))
    joined = df.join(common, F.col(col) == F.col("_class"), "left")
    return joined.select(*[F.when(F.col("_common"), F.col(c)).otherwise(other).alias(c) if c == col else F.col(c) for c in df.columns])


def reindex_cols(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in cols])


# -- joins ------------------------------------------------------------------------------------


def qc_passed(key: list[str], *lists: DataFrame) -> DataFrame:
    """Keys that are in all lists."""
    return reduce(lambda a, b: a.join(b.select(*key).distinct(), key, "left_semi"), lists[1:], lists[0].select(*key).distinct())


def align_outer(key: str, *frames: DataFrame) -> DataFrame:
    """One wide row a key from frames of one row a key: union with nulls, then one aggregation instead of chained joins."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return rows.groupBy(key).agg(*[F.max(c).alias(c) for c in rows.columns if c != key])


def align_inner(key: str, *frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.join(b, key), frames)


def reindex(df: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    """A row for each key; null where there was none."""
    return keys.select(*key).join(df, key, "left")


def map_values(df: DataFrame, col: str, lookup: DataFrame, name: str, value: str, out: str) -> DataFrame:
    """Look a column up in a table; Spark broadcasts the table if it is small."""
    return df.join(lookup.select(F.col(name).alias(col), F.col(value).alias(out)), col, "left")


def semi(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids, key, "left_semi")


def anti(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids, key, "left_anti")


def pairs_within(df: DataFrame, group: str, item: str) -> DataFrame:
    """Pairs of a group's items, the smaller first. Meant for groups of bounded size, such as replicates."""
    a = df.select(group, F.col(item).alias("item_a"))
    return a.join(a.withColumnRenamed("item_a", "item_b"), group).filter("item_a < item_b")


# -- set algebra ------------------------------------------------------------------------------


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*frames).distinct()


def expand_ids(bridge: DataFrame, ids: DataFrame) -> DataFrame:
    """Items named by a list ``id`` of groups and items: ``item_id``."""
    names = ids.select(F.col("id").cast("string").alias("id")).distinct()
    by_item = bridge.join(names, bridge["item_id"].cast("string") == names["id"], "left_semi")
    by_group = bridge.join(names, bridge["group_id"].cast("string") == names["id"], "left_semi")
    return by_item.select("item_id").union(by_group.select("item_id")).distinct()


def by_number(col: str) -> list[Column]:
    """Order accessions by their numeric part, then by name."""
    text = F.col(col).cast("string")
    return [F.regexp_extract(text, r"(\d+)", 1).try_cast("long").asc(), text.asc()]


def work_list(bridge: DataFrame, targets: DataFrame | None = None, completed: DataFrame | None = None, problems: DataFrame | None = None, subset: DataFrame | None = None, size: int | None = None) -> DataFrame:
    """Rows of the bridge to work on: (targets - completed - problems) within subset, the first ``size`` items by number."""
    left = bridge if targets is None else bridge.join(expand_ids(bridge, targets), "item_id", "left_semi")
    for done in (completed, problems):
        if done is not None:
            left = left.join(expand_ids(bridge, done), "item_id", "left_anti")
    if subset is not None:
        left = left.join(expand_ids(bridge, subset), "item_id", "left_semi")
    left = left.select(*bridge.columns)
    return left if size is None else take_queue(left, "item_id", size)


def take_queue(df: DataFrame, col: str, n: int) -> DataFrame:
    return df.orderBy(*by_number(col)).limit(n)


def upsert(base: DataFrame, updates: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """The base with updated keys replaced; of several updates of a key the last by ``order`` counts."""
    if order:
        columns = [c for c in updates.columns if c != key]
        updates = updates.groupBy(key).agg(F.max_by(F.struct(*columns), order).alias("_last")).select(key, "_last.*")
    return base.join(updates, key, "left_anti").unionByName(updates.select(*base.columns))


def reconcile(store: DataFrame, ids: DataFrame, key: str, fill: dict) -> DataFrame:
    """The store brought to a new list of ids: missing ones filled in, others dropped, one row a key."""
    rest = [c for c in store.columns if c != key]
    one = store.groupBy(key).agg(F.min(F.struct(*rest)).alias("_first")).select(key, "_first.*")
    return ids.select(key).distinct().join(one, key, "left").fillna(fill).select(*store.columns)


def push(ids: DataFrame, new: DataFrame) -> DataFrame:
    return ids.union(new).distinct()


def pop(ids: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    return anti(ids, gone, key)


def partners(bridge: DataFrame, one: str, other: str) -> DataFrame:
    """Sorted partners of each id."""
    return bridge.groupBy(one).agg(F.array_sort(F.collect_set(other)).alias("partners"))


# -- order, limits, samples -------------------------------------------------------------------


def page(df: DataFrame, order: list, skip: int, limit: int) -> DataFrame:
    return df.orderBy(*order).offset(skip).limit(limit)


def below_percentile(df: DataFrame, col: str, q: float) -> DataFrame:
    from expatlas.operators.aggregates import percentile_columns

    cut = percentile_columns(df, col, {q: "_cut"})
    return df.join(F.broadcast(cut)).filter(F.col(col) < F.col("_cut")).drop("_cut")


def top_fraction(df: DataFrame, order: list, fraction: float) -> DataFrame:
    """Rows are numbered by ranges and cut, so that the fraction taken stays dealt out."""
    from expatlas.operators.aggregates import numbered

    return numbered(df, order).filter(F.col("_number") <= int(df.count() * fraction)).drop("_number")


def most_variable(counts: DataFrame, n: int) -> DataFrame:
    """Features of largest deviation per observation."""
    spread = counts.groupBy("feature_id").agg((F.stddev_samp("count") / F.count("*")).alias("dispersion"))
    return spread.filter("dispersion is not null").orderBy(F.desc("dispersion"), "feature_id").limit(n)


def hashed(col: str, seed: int) -> Column:
    """A pseudo-random order that any engine can repeat."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(col).cast("string")))


def sample_n(df: DataFrame, n: int, key: str, by: str | None = None, seed: int = 0) -> DataFrame:
    """``n`` rows, or ``n`` of each group, in an order that depends on key and seed alone."""
    order = [hashed(key, seed), F.col(key)]
    if by is None:
        return df.orderBy(*order).limit(n)
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("_n") <= n).drop("_n")


def split(df: DataFrame, key: str, fraction: float, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by hash of the key; strata keep their shares as the hash does not know them."""
    place = F.conv(F.substring(hashed(key, seed), 1, 8), 16, 10).cast("long")
    return gate(df, place < int(fraction * 2**32))

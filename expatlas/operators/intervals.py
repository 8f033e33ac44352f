"""Closed intervals (islands, segments, overlap joins) and half-open coverage runs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from expatlas.operators.aggregates import sequence_ids
from expatlas.scratch import materialize, ship


def islands(df: DataFrame, by: list[str], start: str = "start", stop: str = "stop", touching: bool = False, tile: int = 1 << 16) -> DataFrame:
    """Add ``island``, the first start of the group of overlapping closed intervals.

    Two intervals overlap if one begins before the other's end; sharing only an end point is no
    overlap, unless ``touching``, which also joins neighbours at distance 1 (half-open: 0). An
    interval of one point belongs with an equal start only if it is longer.

    There are few chromosomes, so a window over one would be a few huge tasks: starts are cut into
    tiles, each tile's largest end is carried over the short list of tiles, and the rest happens
    within tiles.
    """
    s, e = F.col(start), F.col(stop)
    placed = df.withColumn("_tile", F.floor(s / tile))
    ends = placed.groupBy(*by, "_tile").agg(F.max(e).alias("_e"))
    earlier = Window.partitionBy(*by).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*by, "_tile", F.max("_e").over(earlier).alias("_carried"))
    inside = Window.partitionBy(*by, "_tile").orderBy(start, stop)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = placed.join(ends, [*by, "_tile"]).withColumn("_last", F.greatest(F.max(e).over(before), "_carried"))
    rows = rows.withColumn("_previous", F.lag(s).over(inside))
    same = s <= F.col("_last") if touching else (s < F.col("_last")) | ((s == F.col("_previous")) & (e > s))
    rows = rows.withColumn("_head", F.when(~F.coalesce(same, F.lit(False)), s))
    heads = rows.groupBy(*by, "_tile").agg(F.max("_head").alias("_h")).select(*by, "_tile", F.max("_h").over(earlier).alias("_open"))
    upto = inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)  # equal intervals count as one place
    out = rows.join(heads, [*by, "_tile"]).withColumn("island", F.coalesce(F.max("_head").over(upto), "_open"))
    return out.select(*df.columns, "island")


def fuse(df: DataFrame, by: list[str], attribute: str) -> DataFrame:
    """One row an island: bounds, attributes of all members, strand if they agree."""
    strand = [F.when(F.count_distinct("strand") == 1, F.min("strand")).alias("strand")] if "strand" in df.columns and "strand" not in by else []
    rows = islands(df, by).groupBy(*by, "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.array_sort(F.collect_set(attribute)).alias("members"), *strand)
    return rows.drop("island")


def named_fusions(df: DataFrame, by: list[str], attribute: str) -> DataFrame:
    return sequence_ids(fuse(df, by, attribute), [*by, "start", "stop"], "FUS%06d", "fusion_id")


def segment(df: DataFrame, by: list[str], attribute: str, tile: int = 1 << 10) -> DataFrame:
    """Disjoint pieces of islands, cut at every start and after every end, with the attributes of what covers them.

    Pieces meet the intervals over them by tile: an interval is listed in the tiles that it touches, a
    piece in the tile of its start, so that a long chain of overlaps is no single join key. Every
    piece lies within all of the intervals that hold its start.
    """
    rows = islands(df, by)
    edges = rows.select(*by, "island", F.explode(F.array(F.col("start"), F.col("stop") + 1)).alias("start")).distinct()
    cut = edges.withColumn("_tile", F.floor(F.col("start") / tile))
    within = F.lead("start").over(Window.partitionBy(*by, "island", "_tile").orderBy("start"))
    heads = cut.groupBy(*by, "island", "_tile").agg(F.min("start").alias("_head"))
    heads = heads.select(*by, "island", "_tile", F.lead("_head").over(Window.partitionBy(*by, "island").orderBy("_tile")).alias("_next"))
    pieces = cut.withColumn("_in", within).join(heads, [*by, "island", "_tile"]).withColumn("stop", F.coalesce("_in", "_next") - 1).filter("stop is not null")
    cover = rows.select(*by, "island", F.col("start").alias("_s"), F.col("stop").alias("_e"), F.col(attribute).alias("_m"))
    cover = cover.withColumn("_tile", F.explode(F.sequence(F.floor(F.col("_s") / tile), F.floor(F.col("_e") / tile))))
    met = pieces.select(*by, "island", "_tile", "start", "stop").join(cover, [*by, "island", "_tile"]).filter("_s <= start and _e >= stop")
    return met.groupBy(*by, "start", "stop").agg(F.array_sort(F.collect_set("_m")).alias("members"))


def bin_for(a: DataFrame, b: DataFrame) -> int:
    """A power of two about the mean length of the intervals: bins are then some three rows an interval at most, and
    rows that meet in a bin are some few times the pairs that overlap, however dense the intervals are."""
    spans = a.select("start", "stop").union(b.select("start", "stop"))
    mean = spans.agg(F.avg(F.greatest(F.col("stop") - F.col("start"), F.lit(0)))).first()[0] or 0
    return 1 << max(0, int(mean).bit_length())


def overlap_join(a: DataFrame, b: DataFrame, by: list[str], bin_size: int | None = None) -> DataFrame:
    """Pairs that overlap as in ``islands``; columns of ``b`` get the prefix ``b_``.

    Both sides are listed in the bins they touch and joined on (group, bin); a pair is kept in its
    first common bin only, so that it comes once. Bins are as wide as intervals are long on average.
    """
    bin_size = bin_size or bin_for(a, b)

    def binned(df: DataFrame) -> DataFrame:
        return df.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("start") / bin_size), F.floor(F.col("stop") / bin_size))))

    right = binned(b).withColumnsRenamed({c: f"b_{c}" for c in b.columns if c not in by})
    met = binned(a).join(right, [*by, "_bin"])
    first = F.floor(F.greatest("start", "b_start") / bin_size) == F.col("_bin")
    return met.filter(first & (F.col("start") < F.col("b_stop")) & (F.col("b_start") < F.col("stop"))).drop("_bin")


def intersect_fraction(a: DataFrame, b: DataFrame, by: list[str], fraction: float, reciprocal: bool = False) -> DataFrame:
    """Overlapping pairs that share at least a fraction of ``a`` (and of ``b``)."""
    shared = F.least("stop", "b_stop") - F.greatest("start", "b_start") + 1
    rule = shared >= fraction * (F.col("stop") - F.col("start") + 1)
    if reciprocal:
        rule = rule & (shared >= fraction * (F.col("b_stop") - F.col("b_start") + 1))
    return overlap_join(a, b, by).withColumn("shared", shared).filter(rule)


def slop(df: DataFrame, sizes: DataFrame, b: int, by: str = "chrom") -> DataFrame:
    """Half-open intervals widened by ``b`` on both sides within their chromosome."""
    wide = df.join(sizes, by)
    return wide.withColumn("start", F.greatest(F.col("start") - b, F.lit(0))).withColumn("stop", F.least(F.col("stop") + b, "size")).drop("size")


def merge(df: DataFrame, by: list[str]) -> DataFrame:
    """Union of half-open intervals; touching ones become one."""
    return islands(df, by, touching=True).groupBy(*by, "island").agg(F.max("stop").alias("stop")).withColumnRenamed("island", "start").select(*by, "start", "stop")


def neighbours(df: DataFrame, by: list[str], start: str, stop: str, tile: int = 1 << 16) -> DataFrame:
    """Add ``_ended``, the largest end of the rows before in the order of starts, and ``_next``, the start of the row behind.

    Starts are cut into tiles; ends and starts are carried over the short list of tiles, as in
    ``islands``, so that no task holds a chromosome.
    """
    placed = df.withColumn("_tile", F.floor(F.col(start) / tile))
    tiles, same = Window.partitionBy(*by).orderBy("_tile"), [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in by]
    ends = placed.groupBy(*by, "_tile").agg(F.max(stop).alias("_e"), F.min(start).alias("_s"))
    ends = ends.select(*[F.col(c).alias(f"_k_{c}") for c in by], F.col("_tile").alias("_t"), F.max("_e").over(tiles.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"), F.lead("_s").over(tiles).alias("_behind"))
    inside = Window.partitionBy(*by, "_tile").orderBy(start, stop)
    rows = placed.withColumn("_in", F.max(stop).over(inside.rowsBetween(Window.unboundedPreceding, -1))).withColumn("_out", F.lead(start).over(inside))
    met = rows.join(ends, [*same, F.col("_tile").eqNullSafe(F.col("_t"))])
    return met.select(*df.columns, F.greatest("_in", "_before").alias("_ended"), F.coalesce("_out", "_behind").alias("_next"))


def complement(df: DataFrame, sizes: DataFrame, by: str = "chrom") -> DataFrame:
    """Half-open gaps between merged intervals, up to the ends of each chromosome."""
    merged = merge(df, [by])
    gaps = neighbours(merged, [by], "start", "stop").select(by, F.coalesce("_ended", F.lit(0)).alias("_from"), F.col("start").alias("_to"))
    last = sizes.join(merged.groupBy(by).agg(F.max("stop").alias("_end")), by, "left").select(by, F.coalesce("_end", F.lit(0)).alias("_from"), F.col("size").alias("_to"))
    return gaps.union(last).filter("_from < _to").select(by, F.col("_from").alias("start"), F.col("_to").alias("stop"))


def gaps_between(df: DataFrame, part: str, start: str, end: str, tile: int = 1 << 16) -> DataFrame:
    """What lies between a row's end and the next row's start."""
    rows = neighbours(df.select(part, start, end), [part], start, end, tile)
    return rows.select(part, (F.col(end) + 1).alias("gap_start"), (F.col("_next") - 1).alias("gap_end")).filter("gap_start <= gap_end")


def _tiled(df: DataFrame, tile: int, most: int) -> DataFrame:
    """Coverage runs cut at the borders of tiles, ``_low`` the tile's first place; ``_from`` is where a run began.

    Tiles with over ``most`` runs are halved as often as that takes, so that a dense stretch is many groups.
    """

    def cut(rows: DataFrame, width: Column) -> DataFrame:
        low = F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("stop") - 1) / width)))
        return rows.withColumn("_i", low).withColumn("_low", F.col("_i") * width).withColumns({"start": F.greatest("start", "_low"), "stop": F.least("stop", F.col("_low") + width)}).drop("_i")

    rows = cut(df.filter("start < stop").withColumn("_from", F.col("start")), F.lit(tile))
    halvings = F.least(F.greatest(F.ceil(F.log2(F.count("*") / F.lit(float(most)))), F.lit(0)), F.lit(tile.bit_length() - 1)).cast("int")
    width = F.expr(f"shiftright({tile}, _halved)")
    dense = rows.groupBy("chrom", "_low").agg(halvings.alias("_halved")).select(F.col("chrom").alias("_c"), F.col("_low").alias("_l"), width.alias("_width"))
    met = rows.join(dense, F.col("chrom").eqNullSafe(F.col("_c")) & (F.col("_low") == F.col("_l")))
    return cut(met.drop("_low"), F.col("_width")).drop("_c", "_l", "_width")


#: Rows of places and columns of samples, NaN where a sample has no run, to one value a row.
_REDUCE: dict[str, Callable[[np.ndarray], np.ndarray]] = {
    "sum": lambda v: v.sum(axis=1), "mean": lambda v: v.mean(axis=1), "max": lambda v: v.max(axis=1), "median": lambda v: np.quantile(v, 0.5, axis=1),
    "p75": lambda v: np.quantile(v, 0.75, axis=1), "p95": lambda v: np.quantile(v, 0.95, axis=1), "positive": lambda v: (v > 0).sum(axis=1).astype(float),
}


def _sweep(start: np.ndarray, stop: np.ndarray, begun: np.ndarray, sample: np.ndarray, value: np.ndarray, cells: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Starts, ends and samples' values between all edges of some runs, blocks of ``cells`` numbers at a time.

    Edges are passed in order with every sample's current value at hand, so that the work grows with
    edges times samples. Of overlapping runs of a sample the later one cuts the earlier off.
    """
    order = np.lexsort((begun, start, sample))
    start, stop, sample, value = start[order], stop[order], sample[order], value[order]
    stop[:-1] = np.where(sample[1:] == sample[:-1], np.minimum(stop[:-1], start[1:]), stop[:-1])
    kept = start < stop
    start, stop, sample, value = start[kept], stop[kept], sample[kept], value[kept]
    edges = np.unique(np.concatenate([start, stop]))
    at = np.concatenate([np.searchsorted(edges, stop), np.searchsorted(edges, start)])  # a run's end comes before the next run's start
    who, what = np.concatenate([sample, sample]), np.concatenate([np.full(len(stop), np.nan), value])
    order = np.argsort(at, kind="stable")
    at, who, what = at[order], who[order], what[order]
    state, step = np.full(int(sample.max()) + 1 if len(sample) else 1, np.nan), 0
    step = max(1, cells // len(state))
    for low in range(0, len(edges) - 1, step):
        high = min(low + step, len(edges) - 1)
        a, b = np.searchsorted(at, [low, high])
        block, changed = np.empty((high - low + 1, len(state))), np.zeros((high - low + 1, len(state)), np.int64)
        block[0] = state
        block[at[a:b] - low + 1, who[a:b]] = what[a:b]
        changed[at[a:b] - low + 1, who[a:b]] = at[a:b] - low + 1
        full = np.take_along_axis(block, np.maximum.accumulate(changed, axis=0), axis=0)
        state = full[-1].copy()
        yield edges[low:high], edges[low + 1 : high + 1], full[1:]


def swept(df: DataFrame, how: str, samples: int, missing: str = "zero", tile: int = 1 << 16, most: int = 100_000) -> DataFrame:
    """``chrom, start, stop, value``: an aggregate over samples between any two edges that some run covers.

    Every tile's edges are swept once by one task; ``most`` bounds the runs of a tile. A sample
    without a run, or with a null in it, counts as 0, or makes the place null (``propagate``).
    """
    rows = _tiled(df.select("chrom", "start", "stop", "sample", F.col("value").cast("double").alias("value")), tile, most)
    kind, place = df.schema["chrom"].dataType.simpleString(), {"start": "bigint", "stop": "bigint"}
    ship(df.sparkSession)

    def run(group: pa.Table) -> pa.Table:
        column = lambda c: group.column(c).to_numpy()
        sample = group.column("sample").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        own = int(sample.max()) + 1
        wide = max(own, samples)
        parts = []
        for start, stop, values in _sweep(*(column(c).astype(np.int64) for c in ("start", "stop", "_from")), sample, column("value").astype(float), (1 << 20) * own // wide):
            there = np.count_nonzero(~np.isnan(values), axis=1)
            on = there > 0
            filled = np.zeros((np.count_nonzero(on), wide))
            filled[:, : values.shape[1]] = np.where(np.isnan(values[on]), 0.0, values[on])
            told = _REDUCE[how](filled) if len(filled) else np.zeros(0)
            parts.append(pa.table({"start": start[on], "stop": stop[on], "value": pa.array(told, mask=(there[on] < samples) if missing != "zero" else None)}))
        whole = pa.concat_tables(parts) if parts else pa.table({"start": pa.array([], pa.int64()), "stop": pa.array([], pa.int64()), "value": pa.array([], pa.float64())})
        chrom = pa.DictionaryArray.from_arrays(pa.array(np.zeros(whole.num_rows, np.int32)), group.column("chrom").slice(0, 1).combine_chunks()).dictionary_decode()
        return whole.add_column(0, "chrom", chrom)

    return rows.groupBy("chrom", "_low").applyInArrow(run, f"chrom {kind}, " + ", ".join(f"{c} {t}" for c, t in place.items()) + ", value double")


def merge_coverage(df: DataFrame, how: str, samples: int, missing: str = "zero", region: tuple | None = None, scale: bool = False, threshold: float | None = None) -> DataFrame:
    """One track out of many: an aggregate over samples at every place, equal neighbours joined.

    A sample without a run at a place counts as 0 there, or makes the place null (``propagate``).
    ``scale`` divides by the number of samples and values below ``threshold`` become 0.
    """
    if region:
        chrom, a, b = region
        df = df.filter((F.col("chrom") == chrom) & (F.col("start") < b) & (F.col("stop") > a)).withColumns({"start": F.greatest("start", F.lit(a)), "stop": F.least("stop", F.lit(b))})
    value = F.col("value") / samples if scale else F.col("value")
    if threshold is not None:
        value = F.when(value < threshold, 0.0).otherwise(value)
    return compress(swept(df, how, samples, missing).withColumn("value", value))


def compress(df: DataFrame, tile: int = 1 << 16) -> DataFrame:
    """Join adjacent runs of equal value; nulls never join.

    Runs are compared within tiles of starts; the last run of each tile and the start of the last open
    run are carried over the short list of tiles, as in ``islands``, so that no task holds a chromosome.
    """
    rows = df.withColumn("_tile", F.floor(F.col("start") / tile))
    inside = Window.partitionBy("chrom", "_tile").orderBy("start")
    carried = Window.partitionBy("chrom").orderBy("_tile")
    ends = rows.groupBy("chrom", "_tile").agg(F.max_by(F.struct("stop", "value"), "start").alias("_e"))
    ends = ends.select("chrom", "_tile", F.lag("_e").over(carried).alias("_before"))
    joined = rows.join(ends, ["chrom", "_tile"]).withColumn("_last", F.coalesce(F.lag(F.struct("stop", "value")).over(inside), F.col("_before")))
    same = F.coalesce((F.col("_last.value") == F.col("value")) & (F.col("_last.stop") == F.col("start")), F.lit(False))
    headed = joined.withColumn("_head", F.when(~same, F.col("start")))
    open_ = headed.groupBy("chrom", "_tile").agg(F.max("_head").alias("_h"))
    open_ = open_.select("chrom", "_tile", F.max("_h").over(carried.rowsBetween(Window.unboundedPreceding, -1)).alias("_open"))
    runs = headed.join(open_, ["chrom", "_tile"]).withColumn("_run", F.coalesce(F.max("_head").over(inside), F.col("_open")))
    return runs.groupBy("chrom", F.col("_run").alias("start")).agg(F.max("stop").alias("stop"), F.first("value").alias("value"))


def mapped_share(idxstats: DataFrame, chroms: list[str]) -> DataFrame:
    """Share of each main chromosome in a sample's mapped reads, wide: ``sample`` and a column a chromosome; 0 where it has none."""
    rows = idxstats.filter(F.col("chrom").isin(chroms)).groupBy("sample").pivot("chrom", chroms).agg(F.sum("mapped")).fillna(0)
    total = sum((F.col(c) for c in chroms), F.lit(0))
    return rows.select("sample", *[F.try_divide(F.col(c), total).alias(c) for c in chroms])


def feature_structure(exons: DataFrame, per_task: int = 100_000) -> DataFrame:
    """Transcripts, different exons and different introns of each gene, from exons ``gene, transcript, start, stop``.

    Genes are dealt to as many tasks as make some ``per_task`` exons each, so that what a task sorts and
    counts does not grow with the table.
    """
    known = materialize(exons.select("gene", "transcript", "start", "stop"), "exons")
    tasks = max(int(exons.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-known.count() // per_task))
    own = Window.partitionBy("gene", "transcript").orderBy("start", "stop")
    rows = known.repartition(tasks, "gene").distinct().withColumn("_next", F.lead("start").over(own)).withColumn("_t", F.row_number().over(own) == 1)
    intron = F.when(F.col("_next") > F.col("stop") + 1, F.struct(F.col("stop") + 1, F.col("_next") - 1))
    first = lambda *c: F.row_number().over(Window.partitionBy("gene", *c).orderBy("transcript")) == 1  # noqa: E731  one of equal ones counts
    rows = rows.withColumn("_e", first("start", "stop")).withColumn("_i", intron)
    rows = rows.withColumn("_i", F.col("_i").isNotNull() & first("_i"))
    return rows.groupBy("gene").agg(F.count_if(F.col("_t") & F.col("transcript").isNotNull()).alias("transcripts"), F.count_if("_e").alias("exons"), F.count_if("_i").alias("introns"))


def structure_quartiles(structure: DataFrame) -> DataFrame:
    """Quartiles over genes of each of the three numbers, a row a number."""
    long = structure.unpivot("gene", ["transcripts", "exons", "introns"], "feature", "n")
    return long.groupBy("feature").agg(*[F.percentile("n", F.lit(p)).alias(c) for p, c in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])


def apply_to_intervals(df: DataFrame, **columns: Callable[[Column, Column, Column], Column]) -> DataFrame:
    """New or replaced columns, each made by a caller's function of chromosome, start and stop."""
    return df.withColumns({name: f(F.col("chrom"), F.col("start"), F.col("stop")) for name, f in columns.items()})


def parse_region(text: Column) -> Column:
    """``chr:start-end`` or ``chr_start_end``."""
    pattern = r"^(.+?)[:_](\d+)[-_](\d+)$"
    return F.struct(F.regexp_extract(text, pattern, 1).alias("chrom"), F.regexp_extract(text, pattern, 2).try_cast("long").alias("start"), F.regexp_extract(text, pattern, 3).try_cast("long").alias("stop"))


def effective_size(coverage: DataFrame, sizes: DataFrame) -> DataFrame:
    """Chromosome length without places of zero coverage."""
    empty = coverage.filter("value = 0").groupBy("chrom").agg(F.sum(F.col("stop") - F.col("start")).alias("_zero"))
    return sizes.join(empty, "chrom", "left").select("chrom", (F.col("size") - F.coalesce("_zero", F.lit(0))).alias("effective"))


def feature_metadata(features: DataFrame, names: DataFrame, inclusive: bool = False) -> DataFrame:
    """Lengths of features (end - start, plus 1 if ``inclusive``) with both chromosome names."""
    return features.join(names, "chrom", "left").withColumn("length", F.col("stop") - F.col("start") + int(inclusive))


def coverage_prevalence(df: DataFrame, samples: int) -> DataFrame:
    """Share of the samples with coverage at each place."""
    return compress(swept(df, "positive", samples).withColumn("value", F.col("value") / samples))


def background_level(coverage: DataFrame, features: DataFrame, sizes: DataFrame, q: float = 0.99) -> DataFrame:
    """Median over chromosomes of the coverage percentile outside features; uncovered places are zeros."""
    gaps = complement(features, sizes)
    met = overlap_join(gaps, coverage.select("chrom", "start", "stop", "value"), ["chrom"])
    parts = met.select("chrom", F.col("b_value").alias("value"), (F.least("stop", "b_stop") - F.greatest("start", "b_start")).alias("n"))
    whole = gaps.groupBy("chrom").agg(F.sum(F.col("stop") - F.col("start")).alias("_n"))
    zero = whole.join(parts.groupBy("chrom").agg(F.sum("n").alias("_c")), "chrom", "left").select("chrom", F.lit(0.0).alias("value"), (F.col("_n") - F.coalesce("_c", F.lit(0))).alias("n"))
    weighted = parts.union(zero).filter("n > 0").groupBy("chrom").agg(F.percentile("value", F.lit(q), F.col("n")).alias("level"))
    return weighted.agg(F.median("level").alias("level"))


def subtract_clip(df: DataFrame, level: float) -> DataFrame:
    return df.withColumn("value", F.greatest(F.col("value") - level, F.lit(0.0)))


def scale_by_max(plus: DataFrame, minus: DataFrame) -> DataFrame:
    """Both strands divided by the larger maximum of each chromosome."""
    both = plus.withColumn("strand", F.lit("+")).unionByName(minus.withColumn("strand", F.lit("-")))
    return both.join(both.groupBy("chrom").agg(F.max("value").alias("_max")), "chrom").withColumn("value", F.try_divide("value", "_max")).drop("_max")


def window_around_max(df: DataFrame, flank: int) -> DataFrame:
    top = df.groupBy("chrom").agg(F.min(F.struct((-F.col("value")).alias("v"), F.col("start").alias("s")))["s"].alias("_at"))
    return top.select("chrom", F.greatest(F.col("_at") - flank, F.lit(0)).alias("start"), (F.col("_at") + flank).alias("stop"))

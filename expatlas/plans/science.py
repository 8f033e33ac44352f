"""Queries of intervals, normalisation, outliers, labels, reads and increments over the driver tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from expatlas.operators import intervals as R
from expatlas.operators import labels as T
from expatlas.operators import normalize as N
from expatlas.operators import outliers as M
from expatlas.operators import reads as Q
from expatlas.operators import vectors as V
from expatlas.plans.base import COUNTS, LENGTHS, counts, lengths, query
from expatlas.scratch import materialize, shared_dir, table

# -- intervals: events as closed intervals of minutes, a chromosome a type, two strands ------------

_IV = "iv AS (SELECT event_type AS chrom, CASE WHEN user_id % 2 = 0 THEN '+' ELSE '-' END AS strand, CAST(floor(epoch(ts) / 60) AS BIGINT) - 28400000 AS start, CAST(floor(epoch(ts) / 60) AS BIGINT) - 28400000 + 1 + CAST(floor(value / 4) AS BIGINT) AS stop, CAST(event_id AS VARCHAR) AS name, value FROM events)"
_ISL = """, o AS (SELECT *, max(stop) OVER (PARTITION BY chrom ORDER BY start, stop, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe, lag(start) OVER (PARTITION BY chrom ORDER BY start, stop, name) AS ps FROM iv),
    h AS (SELECT *, CASE WHEN coalesce(start < pe OR (start = ps AND stop > start), false) THEN 0 ELSE 1 END AS head FROM o),
    isl AS (SELECT *, sum(head) OVER (PARTITION BY chrom ORDER BY start, stop, name) AS k FROM h)"""
_MRG = """, mo AS (SELECT *, max(stop) OVER (PARTITION BY chrom ORDER BY start, stop, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM iv),
    mk AS (SELECT *, sum(CASE WHEN start <= pe THEN 0 ELSE 1 END) OVER (PARTITION BY chrom ORDER BY start, stop, name) AS k FROM mo),
    merged AS (SELECT chrom, min(start) AS start, max(stop) AS stop FROM mk GROUP BY chrom, k)"""
_SZ = "sizes AS (SELECT chrom, max(stop) + 1000 AS size FROM iv GROUP BY 1)"


def intervals(spark, d):
    minute = F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).cast("long") * 1440 + F.hour("ts") * 60 + F.minute("ts") - 28400000
    return table(spark, d, "events").select(F.col("event_type").alias("chrom"), F.when(F.col("user_id") % 2 == 0, "+").otherwise("-").alias("strand"), minute.alias("start"), (minute + 1 + F.floor(F.col("value") / 4)).alias("stop"), F.col("event_id").cast("string").alias("name"), "value")


def sizes(spark, d):
    return intervals(spark, d).groupBy("chrom").agg((F.max("stop") + 1000).alias("size"))


@query(f"WITH {_IV}{_ISL} SELECT name, min(start) OVER (PARTITION BY chrom, k) AS island FROM isl")
def r01_islands(spark, d):
    return R.islands(intervals(spark, d), ["chrom"]).select("name", "island")


@query(f"WITH {_IV}{_ISL} SELECT chrom, min(start) AS start, max(stop) AS stop, list_sort(list(DISTINCT name)) AS members, CASE WHEN count(DISTINCT strand) = 1 THEN min(strand) END AS strand FROM isl GROUP BY chrom, k")
def r02_fuse(spark, d):
    return R.fuse(intervals(spark, d), ["chrom"], "name")


@query(f"WITH {_IV}{_ISL}, e AS (SELECT DISTINCT chrom, k, unnest([start, stop + 1]) AS s FROM isl), p AS (SELECT chrom, k, s AS start, lead(s) OVER (PARTITION BY chrom, k ORDER BY s) - 1 AS stop FROM e) SELECT p.chrom, p.start, p.stop, list_sort(list(DISTINCT i.name)) AS members FROM p JOIN isl i ON p.chrom = i.chrom AND p.k = i.k AND i.start <= p.start AND i.stop >= p.stop WHERE p.stop IS NOT NULL GROUP BY 1, 2, 3")
def r03_segment(spark, d):
    return R.segment(intervals(spark, d), ["chrom"], "name")


def _halves(spark, d):
    x = intervals(spark, d)
    even = F.col("name").cast("long") % 2
    return x.filter(even == 0).select("chrom", "start", "stop", "name"), x.filter(even == 1).select("chrom", "start", "stop", "name")


_HALVES = "a AS (SELECT * FROM iv WHERE CAST(name AS BIGINT) % 2 = 0), b AS (SELECT * FROM iv WHERE CAST(name AS BIGINT) % 2 = 1)"


@query(f"WITH {_IV}, {_HALVES} SELECT a.name, b.name AS b_name FROM a JOIN b ON a.chrom = b.chrom AND a.start < b.stop AND b.start < a.stop")
def r04_overlap_join(spark, d):
    return R.overlap_join(*_halves(spark, d), ["chrom"]).select("name", "b_name")


@query(f"WITH {_IV}, {_SZ} SELECT name, greatest(start - 500, 0) AS start, least(stop + 500, size) AS stop FROM iv JOIN sizes USING (chrom)")
def r05_slop(spark, d):
    return R.slop(intervals(spark, d), sizes(spark, d), 500).select("name", "start", "stop")


@query(f"WITH {_IV}{_MRG} SELECT * FROM merged")
def r06_merge(spark, d):
    return R.merge(intervals(spark, d), ["chrom"])


@query(f"WITH {_IV}{_MRG}, {_SZ}, g AS (SELECT chrom, coalesce(lag(stop) OVER (PARTITION BY chrom ORDER BY start), 0) AS start, start AS stop FROM merged UNION ALL SELECT chrom, max(stop), max(size) FROM merged JOIN sizes USING (chrom) GROUP BY chrom) SELECT * FROM g WHERE start < stop")
def r07_complement(spark, d):
    return R.complement(intervals(spark, d), sizes(spark, d))


_TRACK = """track AS (SELECT chrom, CAST(event_id % 3 AS VARCHAR) AS sample, CAST(event_id * 3 AS BIGINT) AS start, CAST(event_id * 3 + 7 AS BIGINT) AS stop, floor(value / 10) AS value FROM (SELECT event_type AS chrom, * FROM events)),
    edge AS (SELECT DISTINCT chrom, unnest([start, stop]) AS s FROM track), el AS (SELECT chrom, s AS start, lead(s) OVER (PARTITION BY chrom ORDER BY s) AS stop FROM edge),
    cov AS (SELECT el.chrom, el.start, el.stop, list(t.value) AS v FROM el JOIN track t ON t.chrom = el.chrom AND t.start <= el.start AND t.stop >= el.stop WHERE el.stop IS NOT NULL GROUP BY 1, 2, 3)"""


def _track(spark, d):
    """All events as runs of three samples; one sample's runs start 9 apart and so do not overlap."""
    e = table(spark, d, "events")
    return e.select(F.col("event_type").alias("chrom"), (F.col("event_id") % 3).cast("string").alias("sample"), (F.col("event_id") * 3).alias("start"), (F.col("event_id") * 3 + 7).alias("stop"), F.floor(F.col("value") / 10).cast("double").alias("value"))


def _positions(df):
    return df.select("chrom", F.explode(F.sequence("start", F.col("stop") - 1)).alias("pos"), "value")


@query(f"WITH {_TRACK} SELECT chrom, unnest(generate_series(start, stop - 1)) AS pos, list_sum(v) AS value FROM cov")
def r08_merge_coverage_sum(spark, d):
    return _positions(R.merge_coverage(_track(spark, d), "sum", 3))


@query(f"WITH {_TRACK}, w AS (SELECT chrom, start, stop, list_sort(list_concat(v, list_resize([]::DOUBLE[], greatest(3 - len(v), 0), 0.0::DOUBLE))) AS v FROM cov) SELECT chrom, unnest(generate_series(start, stop - 1)) AS pos, list_aggregate(v, 'quantile_cont', 0.75) AS value FROM w")
def r08_merge_coverage_p75(spark, d):
    return _positions(R.merge_coverage(_track(spark, d), "p75", 3))


@query(f"WITH {_TRACK} SELECT chrom, unnest(generate_series(start, stop - 1)) AS pos, CASE WHEN list_sum(v) / 3 < 2 THEN 0.0 ELSE list_sum(v) / 3 END AS value FROM cov")
def r09_scaled_threshold(spark, d):
    return _positions(R.merge_coverage(_track(spark, d), "sum", 3, scale=True, threshold=2.0))


@query("WITH x AS (SELECT user_id AS chrom, event_id, floor(value / 50) AS v, lag(floor(value / 50)) OVER (PARTITION BY user_id ORDER BY event_id) AS p, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events), k AS (SELECT *, sum(CASE WHEN v = p THEN 0 ELSE 1 END) OVER (PARTITION BY chrom ORDER BY r) AS g FROM x) SELECT chrom, min(r) AS start, max(r) + 1 AS stop, any_value(v) AS value FROM k GROUP BY chrom, g")
def r10_compress(spark, d):
    from pyspark.sql import Window

    x = table(spark, d, "events").select(F.col("user_id").alias("chrom"), F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).cast("long").alias("start"), F.floor(F.col("value") / 50).cast("double").alias("value"))
    return R.compress(x.withColumn("stop", F.col("start") + 1))


@query("SELECT event_id, 'chr' || user_id AS chrom, event_id AS start, event_id + 10 AS stop FROM events")
def r11_parse_region(spark, d):
    text = F.concat(F.lit("chr"), "user_id", F.lit(":"), "event_id", F.lit("-"), F.col("event_id") + 10)
    return table(spark, d, "events").select("event_id", R.parse_region(text).alias("r")).select("event_id", "r.*")


@query(f"WITH {_IV}, {_SZ} SELECT chrom, size - coalesce((SELECT CAST(sum(stop - start) AS BIGINT) FROM iv WHERE iv.chrom = sizes.chrom AND value < 1), 0) AS effective FROM sizes")
def r12_effective_size(spark, d):
    return R.effective_size(intervals(spark, d).withColumn("value", F.when(F.col("value") < 1, 0.0).otherwise(1.0)), sizes(spark, d))


@query(f"WITH {_IV} SELECT name, n_name, stop - start AS length FROM iv LEFT JOIN (SELECT n_name, ['click', 'view', 'error', 'purchase', 'signup'][n_nationkey + 1] AS chrom FROM nation WHERE n_nationkey < 5) USING (chrom)")
def r13_feature_metadata(spark, d):
    names = table(spark, d, "nation").filter("n_nationkey < 5").select(F.get(F.array(*[F.lit(x) for x in ("click", "view", "error", "purchase", "signup")]), F.col("n_nationkey")).alias("chrom"), "n_name")
    return R.feature_metadata(intervals(spark, d), names).select("name", "n_name", "length")


@query(f"WITH {_IV}, {_HALVES} SELECT a.name, b.name AS b_name, least(a.stop, b.stop) - greatest(a.start, b.start) + 1 AS shared FROM a JOIN b ON a.chrom = b.chrom AND a.start < b.stop AND b.start < a.stop WHERE least(a.stop, b.stop) - greatest(a.start, b.start) + 1 >= 0.9 * (a.stop - a.start + 1) AND least(a.stop, b.stop) - greatest(a.start, b.start) + 1 >= 0.9 * (b.stop - b.start + 1)")
def r15_intersect_fraction(spark, d):
    return R.intersect_fraction(*_halves(spark, d), ["chrom"], 0.9, True).select("name", "b_name", "shared")


@query(f"""WITH {_IV}, ev AS (SELECT * FROM iv WHERE CAST(name AS BIGINT) % 2 = 0){_MRG.replace("FROM iv)", "FROM ev)")}, {_SZ}, {_TRACK},
    g AS (SELECT chrom, coalesce(lag(stop) OVER (PARTITION BY chrom ORDER BY start), 0) AS start, start AS stop FROM merged UNION ALL SELECT chrom, max(stop), max(size) FROM merged JOIN sizes USING (chrom) GROUP BY chrom),
    held AS (SELECT chrom, unnest(generate_series(start, stop - 1)) AS pos, list_sum(v) AS value FROM cov), free AS (SELECT chrom, unnest(generate_series(start, stop - 1)) AS pos FROM g WHERE start < stop)
    SELECT median(level) AS level FROM (SELECT chrom, quantile_cont(coalesce(value, 0), 0.99) AS level FROM free LEFT JOIN held USING (chrom, pos) GROUP BY chrom)""")
def r16_background_level(spark, d):
    a = intervals(spark, d).filter(F.col("name").cast("long") % 2 == 0).select("chrom", "start", "stop", "name")
    return R.background_level(R.merge_coverage(_track(spark, d), "sum", 3), a, sizes(spark, d))


@query(f"WITH {_IV} SELECT name, greatest(value - 20, 0) AS value FROM iv")
def r16_subtract_clip(spark, d):
    return R.subtract_clip(intervals(spark, d), 20.0).select("name", "value")


@query(f"WITH {_TRACK} SELECT chrom, unnest(generate_series(start, stop - 1)) AS pos, CAST(len(list_filter(v, lambda x: x > 0)) AS DOUBLE) / 3 AS value FROM cov")
def r17_coverage_prevalence(spark, d):
    return _positions(R.coverage_prevalence(_track(spark, d), 3))


@query(f"WITH {_IV} SELECT name, round(value / max(value) OVER (PARTITION BY chrom), 8) AS value FROM iv")
def r18_scale_by_max(spark, d):
    x = intervals(spark, d)
    return R.scale_by_max(x.filter("strand = '+'").drop("strand"), x.filter("strand = '-'").drop("strand")).select("name", F.round("value", 8).alias("value"))


@query(f"WITH {_IV}, t AS (SELECT chrom, min((-value, start))[2] AS peak FROM iv GROUP BY chrom) SELECT chrom, greatest(peak - 500, 0) AS start, peak + 500 AS stop FROM t")
def r18_window_around_max(spark, d):
    return R.window_around_max(intervals(spark, d), 500)


# -- normalisation and statistics -------------------------------------------------------------------


@query(f"WITH {COUNTS} SELECT group_id, feature_id, round(log2(count / sum(count) OVER (PARTITION BY group_id) * 1e6 + 1), 6) AS cpm FROM counts")
def n01_cpm(spark, d):
    return N.cpm(counts(spark, d), log="log2").select("group_id", "feature_id", F.round("cpm", 6).alias("cpm"))


@query(f"WITH {COUNTS} SELECT group_id, feature_id, round(sqrt(count / sum(count) OVER (PARTITION BY group_id) * 1e6), 6) AS cpm FROM counts")
def x02_own_function(spark, d):
    """A caller's function of the normalised value in place of a logarithm."""
    return N.cpm(counts(spark, d), log=lambda c: F.sqrt(c)).select("group_id", "feature_id", F.round("cpm", 6).alias("cpm"))


@query(f"WITH {COUNTS}, {LENGTHS}, t AS (SELECT *, sum(count) OVER (PARTITION BY group_id) AS total FROM counts) SELECT group_id, feature_id, round(count * 1e9 / (total * length), 4) AS rpkm FROM t JOIN lengths USING (feature_id)")
def n02_rpkm(spark, d):
    return N.rpkm(counts(spark, d), lengths(spark, d)).select("group_id", "feature_id", F.round("rpkm", 4).alias("rpkm"))


@query(f"WITH {COUNTS}, {LENGTHS}, r AS (SELECT group_id, feature_id, count / length AS rate FROM counts JOIN lengths USING (feature_id)) SELECT group_id, feature_id, round(rate / sum(rate) OVER (PARTITION BY group_id) * 1e6, 4) AS tpm FROM r")
def n03_tpm(spark, d):
    return N.tpm(counts(spark, d), lengths(spark, d)).select("group_id", "feature_id", F.round("tpm", 4).alias("tpm"))


@query(f"WITH {COUNTS}, {LENGTHS}, t AS (SELECT *, sum(count) OVER (PARTITION BY group_id) AS total FROM counts), r AS (SELECT *, count / length AS rate FROM t JOIN lengths USING (feature_id)) SELECT group_id, feature_id, round(count / total * 1e6, 4) AS cpm, round(count * 1e9 / (total * length), 4) AS rpkm, round(rate / sum(rate) OVER (PARTITION BY group_id) * 1e6, 4) AS tpm FROM r")
def n04_normalize_all(spark, d):
    x = N.normalize_all(counts(spark, d), lengths(spark, d))
    return x.select("group_id", "feature_id", *[F.round(c, 4).alias(c) for c in ("cpm", "rpkm", "tpm")])


_PV = f"""{COUNTS}, pr AS (SELECT a.s_suppkey AS item_a, b.s_suppkey AS item_b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey),
    pv AS (SELECT item_a, item_b, feature_id, CAST(coalesce(sum(x), 0) AS DOUBLE) AS x, CAST(coalesce(sum(y), 0) AS DOUBLE) AS y FROM (SELECT item_a, item_b, feature_id, count AS x, 0 AS y FROM pr JOIN counts ON group_id = item_a UNION ALL SELECT item_a, item_b, feature_id, 0, count FROM pr JOIN counts ON group_id = item_b) GROUP BY 1, 2, 3)"""


def _items(spark, d):
    return counts(spark, d).withColumnRenamed("group_id", "item_id")


def _replicates(spark, d):
    """Suppliers of a nation as replicates of each other."""
    return _groups(spark, d).select("group_id", "item_id")


@query(f"WITH {_PV}, rk AS (SELECT item_a, item_b, rank() OVER (PARTITION BY item_a, item_b ORDER BY x) + (count(*) OVER (PARTITION BY item_a, item_b, x) - 1) / 2 AS rx, rank() OVER (PARTITION BY item_a, item_b ORDER BY y) + (count(*) OVER (PARTITION BY item_a, item_b, y) - 1) / 2 AS ry FROM pv WHERE x + y > 10) SELECT item_a, item_b, round(corr(rx, ry), 6) AS corr, count(*) AS features FROM rk GROUP BY 1, 2")
def n05_pair_corr(spark, d):
    x = N.pair_corr(_items(spark, d), _replicates(spark, d), threshold=10)
    return x.withColumn("corr", F.round("corr", 6))


@query(f"""WITH {COUNTS}, g AS (SELECT DISTINCT group_id FROM counts), f AS (SELECT DISTINCT feature_id FROM counts),
    x AS (SELECT g.group_id, f.feature_id, coalesce(count, 0) AS count FROM g CROSS JOIN f LEFT JOIN counts c ON c.group_id = g.group_id AND c.feature_id = f.feature_id),
    rk AS (SELECT group_id, feature_id, rank() OVER (PARTITION BY group_id ORDER BY count) + (count(*) OVER (PARTITION BY group_id, count) - 1) / 2 AS r FROM x)
    SELECT a.group_id AS a, b.group_id AS b, round(corr(a.r, b.r), 5) + 0.0 AS corr FROM rk a JOIN rk b ON a.feature_id = b.feature_id GROUP BY 1, 2""")
def n06_corr_matrix(spark, d):
    return N.corr_matrix(counts(spark, d)).withColumn("corr", F.round("corr", 5) + 0.0)


@query(f"WITH {_PV}, t AS (SELECT *, sum(x) OVER (PARTITION BY item_a, item_b) AS tx, sum(y) OVER (PARTITION BY item_a, item_b) AS ty FROM pv), e AS (SELECT *, (x + y) * tx / (tx + ty) AS ex, (x + y) * ty / (tx + ty) AS ey FROM t WHERE x + y > 10) SELECT item_a, item_b, round(sqrt(sum(pow(x - ex, 2) / ex + pow(y - ey, 2) / ey) / count(*)), 6) AS sere FROM e GROUP BY 1, 2")
def n07_sere(spark, d):
    return N.sere(_items(spark, d), _replicates(spark, d), 10).withColumn("sere", F.round("sere", 6))


@query("WITH x AS (SELECT o_orderstatus AS chrom, o_orderkey AS pos, o_totalprice AS v, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice, o_orderkey) AS r, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_custkey, o_orderkey) AS q, CAST(o_custkey AS DOUBLE) AS w FROM orders), m AS (SELECT a.chrom, a.r, (a.v + b.w) / 2 AS m FROM x a JOIN x b ON a.chrom = b.chrom AND a.r = b.q) SELECT x.chrom, x.pos, round(a.m - b.m, 4) + 0.0 AS diff FROM x JOIN m a ON a.chrom = x.chrom AND a.r = x.r JOIN m b ON b.chrom = x.chrom AND b.r = x.q")
def n08_quantile_diff(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderstatus").alias("chrom"), F.col("o_orderkey").alias("pos"), "o_totalprice", F.col("o_custkey").cast("double").alias("w"))
    return N.quantile_diff(o.select("chrom", "pos", F.col("o_totalprice").alias("value")), o.select("chrom", "pos", F.col("w").alias("value"))).withColumn("diff", F.round("diff", 4) + 0.0)


def _groups(spark, d):
    return table(spark, d, "supplier").select(F.col("s_nationkey").alias("group_id"), F.col("s_suppkey").alias("item_id"), F.col("s_acctbal").alias("libsize"))


@query(f"WITH {_PV}, c AS (SELECT item_a, corr(x, y) AS corr FROM pv GROUP BY item_a, item_b), g AS (SELECT s_nationkey AS group_id, count(*) AS items FROM supplier GROUP BY 1), l AS (SELECT s_nationkey AS group_id, min(corr) AS low FROM c JOIN supplier ON s_suppkey = item_a GROUP BY 1) SELECT group_id, items FROM g LEFT JOIN l USING (group_id) WHERE items = 1 OR low >= -0.3")
def n09_mergeable_groups(spark, d):
    return N.mergeable_groups(_groups(spark, d), N.pair_corr(_items(spark, d), _replicates(spark, d), "pearson"), -0.3)


@query(f"""WITH {COUNTS}, f AS (SELECT DISTINCT feature_id FROM counts), s AS (SELECT s_nationkey AS g, s_suppkey AS i, s_acctbal AS size, count(*) OVER (PARTITION BY s_nationkey) AS items, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS r FROM supplier),
    x AS (SELECT g, i, items, f.feature_id, CAST(coalesce(count, 0) AS DOUBLE) AS x FROM s CROSS JOIN f LEFT JOIN counts ON group_id = i AND counts.feature_id = f.feature_id),
    m AS (SELECT g, feature_id, median(x) AS m FROM x WHERE items > 2 GROUP BY 1, 2),
    c AS (SELECT x.i, corr(x.x, m.m) AS c FROM x JOIN m USING (g, feature_id) GROUP BY 1 UNION ALL SELECT a.i, corr(a.x, b.x) FROM x a JOIN x b ON a.g = b.g AND a.feature_id = b.feature_id AND a.i <> b.i WHERE a.items = 2 GROUP BY 1)
    SELECT g AS group_id, s.i AS item_id, CASE items WHEN 1 THEN 'singleton' WHEN 2 THEN 'pair' ELSE 'multi' END AS kind, CASE WHEN c IS NULL OR isnan(c) THEN false WHEN items = 2 THEN c < 0.5 AND r > 1 ELSE c < 0.5 END AS "drop" FROM s LEFT JOIN c ON c.i = s.i""")
def n10_replicate_flags(spark, d):
    return N.replicate_flags(_groups(spark, d), _items(spark, d), 0.5)


@query()
def n11_bootstrap_cutoff(spark, d):
    return N.bootstrap_cutoff(N.pair_corr(_items(spark, d), _replicates(spark, d)))


def _quality_cells(spark, d):
    x = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").groupBy("source").pivot("quality", [0, 1]).count().fillna(0).unpivot("source", ["0", "1"], "quality", "n")
    return x.withColumn("quality", F.col("quality").cast("int"))


@query("""WITH n AS (SELECT source, quality, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2), c AS (SELECT s.source, q.quality, coalesce(n, 0) AS n FROM (SELECT DISTINCT source FROM n) s CROSS JOIN (SELECT DISTINCT quality FROM n) q LEFT JOIN n ON n.source = s.source AND n.quality = q.quality),
    e AS (SELECT *, sum(n) OVER (PARTITION BY source) * sum(n) OVER (PARTITION BY quality) / sum(n) OVER () AS expected, 1 - sum(n) OVER (PARTITION BY source) / sum(n) OVER () AS ra, 1 - sum(n) OVER (PARTITION BY quality) / sum(n) OVER () AS rb FROM c),
    r AS (SELECT *, n - expected AS residual, (n - expected) / sqrt(expected * ra * rb) AS adjusted, (n - expected) * (n - expected) / expected AS x2 FROM e),
    p AS (SELECT *, exp(-adjusted * adjusted / 2) / sqrt(2 * pi()) AS p FROM r),
    k AS (SELECT *, row_number() OVER (ORDER BY p, source, quality) AS k, count(*) OVER () AS m FROM p),
    q AS (SELECT *, least(1.0, min(p * m / k) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS q FROM k)
    SELECT source, quality, n, round(expected, 4) AS expected, round(residual, 4) AS residual, round(adjusted, 4) AS adjusted, round(x2, 4) AS x2, round(p, 4) AS p, round(q, 4) AS q, q <= 0.05 AS flag FROM q""")
def n12_chisq_posthoc(spark, d):
    x = N.chisq_posthoc(_quality_cells(spark, d), "source", "quality")
    return x.select("source", "quality", "n", *[F.round(c, 4).alias(c) for c in ("expected", "residual", "adjusted", "x2", "p", "q")], "flag")


@query("""WITH n AS (SELECT source, quality, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2), c AS (SELECT s.source, q.quality, coalesce(n, 0) AS n FROM (SELECT DISTINCT source FROM n) s CROSS JOIN (SELECT DISTINCT quality FROM n) q LEFT JOIN n ON n.source = s.source AND n.quality = q.quality),
    e AS (SELECT *, sum(n) OVER (PARTITION BY source) * sum(n) OVER (PARTITION BY quality) / sum(n) OVER () AS expected FROM c), k AS (SELECT (count(DISTINCT source) - 1) * (count(DISTINCT quality) - 1) AS df FROM e)
    SELECT k.df, round(sum(CASE WHEN k.df = 1 THEN pow(greatest(abs(n - expected) - 0.5, 0), 2) ELSE pow(n - expected, 2) END / expected), 6) AS chi2 FROM e, k GROUP BY k.df""")
def n12_chisq_test(spark, d):
    """The p-value is checked against tables in the tests, as SQL has no gamma function of two arguments."""
    return N.chisq_test(_quality_cells(spark, d), "source", "quality").select("df", F.round("chi2", 6).alias("chi2"))


@query("SELECT l_orderkey, l_linenumber, round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_pop(l_quantity) FROM lineitem), 6) AS l_quantity FROM lineitem")
def n13_standard_scale(spark, d):
    return N.standard_scale(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), ["l_quantity"]).withColumn("l_quantity", F.round("l_quantity", 6))


def _vectors(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"), "label")


def _principal(spark, d, k):
    cols = [f"c{i}" for i in range(64)]
    x = _vectors(spark, d).select("id", *[F.get("vector", F.lit(i)).alias(c) for i, c in enumerate(cols)])
    return N.pca(x, cols, k)


@query()
def n14_pca(spark, d):
    return _principal(spark, d, 4)[0].select("id", "pc")


@query()
def n14_pca_loadings(spark, d):
    return _principal(spark, d, 4)[2]


@query()
def n14_wide_pca(spark, d):
    """Groups by features as a long table; up to 50 components, of as many features as there are."""
    return V.wide_pca(counts(spark, d), "group_id", "feature_id", "count", 50)[0]


@query("SELECT CAST(i - 1 AS INTEGER) AS i, CAST(j - 1 AS INTEGER) AS j, round(covar_pop(CAST(embedding[i] AS DOUBLE), CAST(embedding[j] AS DOUBLE)), 8) + 0.0 AS cov FROM embeddings, range(1, 65) a(i), range(1, 65) b(j) WHERE i <= j GROUP BY 1, 2")
def n15_covariance(spark, d):
    return V.covariance_rows(_vectors(spark, d)).withColumn("cov", F.round("cov", 8) + 0.0)


@query()
def n16_knn(spark, d):
    """By Mahalanobis distance; every row whose id is divisible by 50 asks."""
    v = _vectors(spark, d).drop("label")
    white = materialize(V.whiten(v, V.shrunk_cov(v)[1]), "white")
    return V.knn_indexed(white, white.filter("id % 50 = 0"), 5)


@query("""WITH v AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), r AS (SELECT i, min(x) AS a, max(x) AS b FROM v GROUP BY 1),
    e AS (SELECT vec_id, i, CASE WHEN b > a THEN least(9, CAST(floor((x - a) / (b - a) * 10) AS INTEGER)) ELSE 0 END AS k FROM v JOIN r USING (i)), m AS (SELECT vec_id, list(k ORDER BY i) AS e FROM e GROUP BY 1),
    q AS (SELECT q.vec_id AS query, v.vec_id AS id, list_sum(list_transform(list_zip(v.e, q.e), lambda p: CAST(p[1] <> p[2] AS INTEGER))) / 64.0::DOUBLE AS distance FROM m v JOIN m q ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0)
    SELECT query, id, distance, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, id) AS rank FROM q) WHERE rank <= 5""")
def n17_knn_hamming(spark, d):
    """On profiles of ten equal-width bins a component; every row whose id is divisible by 50 asks."""
    v = materialize(N.binned_profiles(_vectors(spark, d).drop("label"), 10), "profiles")
    return V.knn_hamming(v, v.filter("id % 50 = 0"), 5)[0]


@query()
def n18_mahalanobis_to_mean(spark, d):
    return V.mahalanobis_to_mean(_vectors(spark, d), 0.1)


@query("WITH x AS (SELECT o_orderstatus AS label, CASE WHEN o_totalprice > 200000 THEN 'O' WHEN o_totalprice > 100000 THEN 'F' ELSE 'P' END AS pred FROM orders), k AS (SELECT label AS k, count(*) AS n FROM x GROUP BY 1), s AS (SELECT pred AS k, count(*) AS said, count(*) FILTER (label = pred) AS tp FROM x GROUP BY 1) SELECT round((SELECT avg(CAST(label = pred AS INTEGER)) FROM x), 8) AS accuracy, round(sum(tp / said * n) / sum(n), 8) AS weighted_precision FROM k JOIN s USING (k)")
def n19_classification_summary(spark, d):
    x = table(spark, d, "orders").select(F.col("o_orderstatus").alias("label"), F.when(F.col("o_totalprice") > 200000, "O").when(F.col("o_totalprice") > 100000, "F").otherwise("P").alias("pred"))
    return N.classification_summary(x, "label", "pred").select(F.round("accuracy", 8).alias("accuracy"), F.round("weighted_precision", 8).alias("weighted_precision"))


@query(f"""WITH {COUNTS}, g AS (SELECT DISTINCT group_id FROM counts), f AS (SELECT DISTINCT feature_id FROM counts),
    x AS (SELECT g.group_id, f.feature_id, coalesce(count, 0) AS count FROM g CROSS JOIN f LEFT JOIN counts c ON c.group_id = g.group_id AND c.feature_id = f.feature_id),
    rk AS (SELECT group_id, feature_id, rank() OVER (PARTITION BY group_id ORDER BY count) + (count(*) OVER (PARTITION BY group_id, count) - 1) / 2 AS r FROM x),
    k AS (SELECT a.group_id AS a, b.group_id AS b, round(corr(a.r, b.r), 6) + 0.0 AS corr FROM rk a JOIN rk b ON a.feature_id = b.feature_id GROUP BY 1, 2),
    m AS (SELECT a FROM k WHERE a <> b GROUP BY a HAVING median(corr) > 0) SELECT a, b, corr FROM k WHERE a IN (SELECT a FROM m) AND b IN (SELECT a FROM m)""")
def n20_filter_by_median_corr(spark, d):
    return N.filter_by_median_corr(counts(spark, d), 0.0, 6)


@query()
def n21_silhouette_sweep(spark, d):
    return N.silhouette_sweep(_vectors(spark, d), [2, 4])


@query(f"WITH {COUNTS}, c AS (SELECT group_id, feature_id, log2(count / sum(count) OVER (PARTITION BY group_id) * 1e6 + 1) AS cpm FROM counts), k AS (SELECT feature_id, s_nationkey % 2 AS k, cpm FROM c JOIN supplier ON group_id = s_suppkey) SELECT feature_id, round(coalesce(median(cpm) FILTER (k = 0), 0), 6) AS even, round(coalesce(median(cpm) FILTER (k = 1), 0), 6) AS odd FROM k GROUP BY 1")
def a30_norm_medians(spark, d):
    kind = table(spark, d, "supplier").select(F.col("s_suppkey").alias("group_id"), F.when(F.col("s_nationkey") % 2 == 0, "even").otherwise("odd").alias("category"))
    x = N.norm_medians(counts(spark, d), kind, ["even", "odd"])
    return x.select("feature_id", F.round("even", 6).alias("even"), F.round("odd", 6).alias("odd"))


# -- outliers and classifiers: order lines as a feature table ----------------------------------------

_FEATURES = ["quantity", "price", "discount", "days"]


def _features(spark, d):
    o = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.sum("l_quantity").alias("quantity"), F.sum("l_extendedprice").alias("price"), F.avg("l_discount").alias("discount"), F.min("l_returnflag").alias("label"), F.count_distinct("l_shipdate").cast("double").alias("days"))
    return o


@query()
def m03_isolation_forest(spark, d):
    x = _features(spark, d)
    return M.IsolationForest(_FEATURES, "id", 100).fit(x).transform(x).select("id", "score", "outlier")


@query()
def m04_prop_outliers(spark, d):
    x = _features(spark, d)
    return M.split_proportions(M.split_outliers(x, _FEATURES, "id"), ["label"])


@query()
def m05_outliers_by_group(spark, d):
    return M.outliers_by_group(_features(spark, d), "label", _FEATURES, "id").select("id", "label", "score", "outlier")


@query()
def m06_mixin_curve(spark, d):
    x = materialize(_features(spark, d), "features")
    own = x.filter("label = 'A'")
    forest = M.IsolationForest(_FEATURES, "id", 100).fit(own)
    sources = {"N": x.filter("label = 'N'"), "R": x.filter("label = 'R'"), "price": x.filter("label <> 'A'").withColumn("price", F.col("price") * 3)}
    return M.mixin_curves(forest, own, sources, [i / 10 for i in range(11)]).select("fraction", "outliers", "source")


@query("""WITH s AS (SELECT l_orderkey AS id, unnest(['A', 'N', 'R']) AS class, unnest([avg(CAST(l_returnflag = 'A' AS INTEGER)), avg(CAST(l_returnflag = 'N' AS INTEGER)), avg(CAST(l_returnflag = 'R' AS INTEGER))]) AS p FROM lineitem GROUP BY 1)
    SELECT * FROM (SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY p DESC, class) AS INTEGER) AS rank, class, p FROM s) WHERE rank <= 2""")
def w10_top2_classes(spark, d):
    shares = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.array(*[F.avg((F.col("l_returnflag") == c).cast("int")) for c in "ANR"]).alias("probability"))
    return M.top2_classes(shares, "id", ["A", "N", "R"])


@query()
def m07_random_forest(spark, d):
    x = _features(spark, d)
    model = M.train_classifier(x, _FEATURES, "label", 20)
    return M.top2_classes(M.predict(model, x, "label"), "id", model.stages[0].labels)


@query()
def m10_kmeans(spark, d):
    return N.kmeans(_principal(spark, d, 40)[0].select("id", F.col("pc").alias("vector")), 15)


# -- labels and text ---------------------------------------------------------------------------------


@query("SELECT conv_id, turn, replace(replace(lower(role || ' ' || text), 'user', 'person'), 'person the', 'they') AS text FROM conversations")
def t01_build_documents(spark, d):
    x = table(spark, d, "conversations").withColumn("key", F.struct("conv_id", "turn"))
    return T.build_documents(x, "key", ["role", "text"], [("user", "person"), ("person the", "they")]).select("key.*", "text")


_TOK = "tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\w-]+')) AS term FROM documents), ok AS (SELECT * FROM tok WHERE len(term) > 1 AND NOT regexp_matches(term, '^[\\d.-]+$'))"


@query(f"WITH {_TOK}, v AS (SELECT DISTINCT term FROM ok WHERE len(term) = 6), c AS (SELECT doc_id, term, count(*) AS n FROM ok WHERE len(term) = 6 GROUP BY 1, 2), f AS (SELECT * FROM c QUALIFY rank() OVER (PARTITION BY doc_id ORDER BY n DESC) = 1) SELECT doc_id, t AS terms FROM (SELECT doc_id FROM documents) LEFT JOIN (SELECT doc_id, string_agg(term, '|' ORDER BY term) AS t FROM f GROUP BY 1) USING (doc_id)")
def t02_top_terms(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.lower("text").alias("text"))
    from expatlas.functions.text import tokens

    vocabulary = docs.select(F.explode(tokens(F.col("text"))).alias("term")).filter("length(term) = 6").distinct()
    return T.top_terms(docs, "doc_id", "text", vocabulary)


@query(f"WITH {_TOK}, c AS (SELECT doc_id, term, count(*) AS n FROM ok GROUP BY 1, 2), f AS (SELECT term, count(*) AS df FROM c GROUP BY 1 HAVING count(*) >= 2), w AS (SELECT doc_id, term, n * log2((SELECT count(*) FROM documents) / df) AS w FROM c JOIN f USING (term)), l AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM w) SELECT doc_id, string_agg(term, '|' ORDER BY round(w, 9) DESC, term) AS keywords FROM l WHERE w > 0.25 GROUP BY 1")
def t03_keywords(spark, d):
    return T.keywords(table(spark, d, "documents"), "doc_id", "text")


@query("SELECT o_orderkey, nullif(t, 'None') AS o_orderstatus FROM orders LEFT JOIN (VALUES ('O', 'open'), ('F', 'None')) v(r, t) ON r = o_orderstatus")
def t05_map_vocabulary(spark, d):
    lookup = spark.createDataFrame([("O", "open"), ("F", "None")], "raw string, term string")
    return T.map_vocabulary(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", lookup)


@query("SELECT doc_id, CASE WHEN regexp_matches(lower(text), '(^|\\s)the(\\s|$)') THEN 'english' WHEN regexp_matches(lower(text), '(^|\\s)le(\\s|$)') THEN 'french' END AS guess FROM documents")
def t06_backfill_keyword(spark, d):
    return table(spark, d, "documents").select("doc_id", T.backfill_keyword(F.lit(None).cast("string"), F.lower("text"), [(r"(^|\s)the(\s|$)", "english"), (r"(^|\s)le(\s|$)", "french")]).alias("guess"))


_L3 = """l3 AS (SELECT o_orderkey AS id, CASE o_orderkey % 7 WHEN 0 THEN 'RNA-Seq' WHEN 1 THEN 'OTHER' WHEN 2 THEN 'EST' WHEN 3 THEN 'WGA' WHEN 4 THEN 'ChIP-Seq' WHEN 5 THEN 'OTHER' ELSE 'WGS' END AS sra,
    CASE o_custkey % 5 WHEN 0 THEN 'RNA-Seq' WHEN 1 THEN 'ncRNA-Seq' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE 'ChIP-Seq|RNA-Seq' END AS author, CASE (o_orderkey + o_custkey) % 4 WHEN 0 THEN 'RNA-Seq' WHEN 1 THEN 'WGS' WHEN 2 THEN 'ChIP-Seq' ELSE 'OTHER' END AS pred,
    CASE o_orderkey % 3 WHEN 0 THEN 'ChIP' WHEN 1 THEN 'cDNA' ELSE 'OTHER' END AS sra_selection, CASE o_custkey % 3 WHEN 0 THEN 'ChIP' WHEN 1 THEN 'cDNA' ELSE 'PCR' END AS pred_selection FROM orders),
    st AS (SELECT *, CASE WHEN sra = author AND sra = pred THEN sra
        WHEN author <> '' AND sra = 'OTHER' AND author = pred THEN author
        WHEN author <> '' AND sra = 'OTHER' AND NOT contains(author, '|') THEN author
        WHEN author <> '' AND sra <> pred THEN author || CASE WHEN contains(author, pred) THEN '' ELSE '|' || pred END
            || CASE WHEN contains(author || CASE WHEN contains(author, pred) THEN '' ELSE '|' || pred END, sra) THEN '' ELSE '|' || sra END
        WHEN sra = pred THEN sra WHEN sra = 'EST' AND pred = 'RNA-Seq' THEN 'EST' WHEN sra = 'WGA' AND pred = 'WGS' THEN 'WGA' ELSE pred || '|' || sra END AS strategy,
        CASE WHEN sra_selection = pred_selection THEN sra_selection ELSE pred_selection || '|' || sra_selection END AS selection FROM l3)"""


def _l3(spark, d):
    """Orders as samples with labels from three sources."""

    def pick(number, *labels):
        return F.get(F.array(*[F.lit(x) for x in labels]), (number % len(labels)).cast("int"))

    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, d, "orders").select(
        key.alias("id"),
        pick(key, "RNA-Seq", "OTHER", "EST", "WGA", "ChIP-Seq", "other", "WGS").alias("sra"),
        pick(cust, "RNA-Seq", "ncRNA-Seq", "", None, "ChIP-Seq|RNA-Seq").alias("author"),
        pick(key + cust, "RNA-Seq", "WGS", "ChIP-Seq", "OTHER").alias("pred"),
        pick(key, "ChIP", "cDNA", "other").alias("sra_selection"),
        pick(cust, "ChIP", "cDNA", "PCR").alias("pred_selection"),
        T.reconcile_strategy(F.col("sra"), F.col("author"), F.col("pred")).alias("strategy"),
        T.reconcile_selection(F.col("sra_selection"), F.col("pred_selection")).alias("selection"),
    )


@query(f"WITH {_L3} SELECT id, strategy FROM st")
def t09_reconcile_strategy(spark, d):
    return _l3(spark, d).select("id", "strategy")


@query(f"WITH {_L3} SELECT id, selection FROM st")
def t10_reconcile_selection(spark, d):
    return _l3(spark, d).select("id", "selection")


@query(f"WITH {_L3} SELECT id, CASE WHEN NOT contains(strategy, 'ChIP-Seq') AND contains(selection, 'ChIP') THEN 'ChIP-Seq|' || strategy ELSE strategy END AS strategy, CASE WHEN contains(strategy, 'ChIP-Seq') AND NOT contains(selection, 'ChIP') THEN 'ChIP|' || selection ELSE selection END AS selection FROM st")
def t10_cross_annotate(spark, d):
    strategy, selection = T.cross_annotate(F.col("strategy"), F.col("selection"))
    return _l3(spark, d).select("id", strategy.alias("strategy"), selection.alias("selection"))


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '5-LOW'")
def t11_ids_with_label(spark, d):
    return T.ids_with_label(table(spark, d, "orders"), "o_custkey", "o_orderpriority", "5-LOW")


@query("SELECT c_custkey AS biosample, c_mktsegment, count(*) AS experiments, list_sort(list(DISTINCT o_orderkey)) AS srx FROM customer JOIN orders ON o_custkey = c_custkey WHERE contains(lower(c_mktsegment), 'house') GROUP BY 1, 2")
def t12_search_term(spark, d):
    labels = table(spark, d, "customer").select(F.col("c_custkey").alias("biosample"), "c_mktsegment")
    return T.search_term(labels, table(spark, d, "orders").select(F.col("o_custkey").alias("biosample"), F.col("o_orderkey").alias("srx")), "c_mktsegment", "House")


@query("SELECT n_name AS project, count(DISTINCT c_custkey) AS samples, count(*) AS experiments FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10 OFFSET 5")
def t13_list_projects(spark, d):
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"))
    return T.list_projects(c.select(F.col("n_name").alias("project"), F.col("c_custkey").alias("biosample")), 5, 10)


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'Outlier' WHEN o_orderstatus IN ('O', 'F') THEN o_orderstatus ELSE 'Other' END AS label FROM orders")
def t14_simplify_label(spark, d):
    return table(spark, d, "orders").select("o_orderkey", T.simplify_label(F.col("o_orderstatus"), ["O", "F"], F.col("o_totalprice") > 400000).alias("label"))


@query(f"WITH {_TOK}, c AS (SELECT doc_id, term, count(*) AS n FROM ok GROUP BY 1, 2), f AS (SELECT term, count(*) AS df FROM c GROUP BY 1), w AS (SELECT doc_id, term, (1 + ln(n)) * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w FROM c JOIN f USING (term)), l AS (SELECT term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM w) SELECT DISTINCT term FROM l WHERE w > 0.5")
def t15_tfidf_terms(spark, d):
    return T.tfidf_terms(table(spark, d, "documents"), "doc_id", "text")


# -- reads: conversations as read records ---------------------------------------------------------------


def _reads(spark, d):
    c = table(spark, d, "conversations")
    return c.select(F.col("conv_id").cast("string").alias("item_id"), (F.col("turn") % 2 + 1).cast("int").alias("mate"), F.floor(F.col("turn") / 2).alias("read_no"), F.concat(F.lit("@r"), F.floor(F.col("turn") / 2)).alias("h1"), F.col("text").alias("seq"), F.lit("+").alias("h2"), F.when(F.length("text") % 7 != 0, F.regexp_replace(F.when(F.length("text") % 5 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text")), r"\s", "!")).alias("qual"))


@query("SELECT CAST(conv_id AS VARCHAR) AS item_id, turn, CASE WHEN len(text) % 7 = 0 THEN 'incomplete' WHEN regexp_matches(text, '[^\\x20-\\x7e]') THEN 'bad_encoding' WHEN len(text) % 5 = 0 THEN 'unequal' ELSE 'good' END AS status FROM conversations")
def q01_classify_reads(spark, d):
    return Q.classify_reads(_reads(spark, d)).select("item_id", (F.col("read_no") * 2 + F.col("mate") - 1).alias("turn"), "status")


@query("WITH s AS (SELECT CAST(conv_id AS VARCHAR) AS item_id, turn, len(text) AS l, turn // 2 AS r, CASE WHEN len(text) % 7 = 0 THEN 1 WHEN regexp_matches(text, '[^\\x20-\\x7e]') THEN 2 WHEN len(text) % 5 = 0 THEN 3 ELSE 4 END AS k FROM conversations), p AS (SELECT item_id, r, min(k) AS k, max(l) FILTER (turn % 2 = 0) AS l1, max(l) FILTER (turn % 2 = 1) AS l2 FROM s GROUP BY 1, 2) SELECT item_id, round(avg(l1) FILTER (k = 4), 6) AS avgLen_R1, round(avg(l2) FILTER (k = 4), 6) AS avgLen_R2, count(*) FILTER (k = 4) AS libsize, count(*) FILTER (k = 1) AS incomplete, count(*) FILTER (k = 2) AS bad_encoding, count(*) FILTER (k = 3) AS unequal FROM p GROUP BY 1")
def q02_read_summary(spark, d):
    return Q.read_summary(_reads(spark, d)).withColumns({c: F.round(c, 6) for c in ("avgLen_R1", "avgLen_R2")})


@query("WITH m AS (SELECT CAST(conv_id AS VARCHAR) AS item_id, count(*) FILTER (turn % 2 = 0) AS r1, count(*) FILTER (turn % 2 = 1) AS r2, coalesce(sum(len(text)) FILTER (turn % 2 = 0), 0) AS b1, coalesce(sum(len(text)) FILTER (turn % 2 = 1), 0) AS b2 FROM conversations GROUP BY 1) SELECT item_id, CASE WHEN r1 = 0 OR r2 = 0 THEN 'SE' WHEN r1 <> r2 THEN CASE WHEN b1 >= b2 THEN 'keep_R1' ELSE 'keep_R2' END ELSE 'PE' END AS layout FROM m")
def q03_layout(spark, d):
    return Q.layout(_reads(spark, d))


@query("WITH r AS (SELECT CAST(conv_id AS VARCHAR) AS item_id, turn, CASE WHEN conv_id % 5 = 0 THEN NULL WHEN conv_id % 3 = 0 THEN 'T' || (conv_id * 1000 + turn) ELSE text END AS seq FROM conversations) SELECT item_id, count(seq) = 0 AS empty, coalesce(regexp_matches(arg_min(seq, (turn % 2) * 1000000 + turn), '^T[0-9.]+$'), false) AS color_space FROM r GROUP BY 1")
def q04_item_flags(spark, d):
    conv = F.col("item_id").cast("long")
    turn = F.col("read_no") * 2 + F.col("mate") - 1
    seq = F.when(conv % 5 == 0, None).when(conv % 3 == 0, F.concat(F.lit("T"), (conv * 1000 + turn).cast("string"))).otherwise(F.col("seq"))
    return Q.item_flags(_reads(spark, d).withColumn("seq", seq))


@query("WITH r AS (SELECT CAST(conv_id AS VARCHAR) AS item_id, turn // 2 AS r, regexp_replace(CASE WHEN len(text) % 5 = 0 THEN text || 'x' ELSE text END, '\\s', '!', 'g') AS q FROM conversations WHERE len(text) % 7 <> 0), c AS (SELECT item_id, unnest(list_transform(string_split(q, ''), lambda x: unicode(x))) AS c FROM r WHERE r % 10 = 0 AND r < 5000 AND len(q) > 0), s AS (SELECT item_id, min(c) AS low, max(c) AS high FROM c GROUP BY 1) SELECT item_id, CAST(low AS INTEGER) AS low, CAST(high AS INTEGER) AS high, CAST(CASE WHEN low < 59 THEN 33 WHEN high > 74 THEN 64 ELSE 33 END AS INTEGER) AS offset FROM s")
def q06_quality_encoding(spark, d):
    return Q.quality_encoding(_reads(spark, d))


# -- increments: the event table arrives as files and is appended once a key ----------------------------


@query("SELECT user_id, max(value) AS value FROM events GROUP BY 1")
def i02_stream_metrics(spark, d):
    from expatlas.streaming.increment import stream_metrics

    rows = materialize(table(spark, d, "events").groupBy("user_id").agg(F.max("value").alias("value")), "arriving")
    base = f"{shared_dir(spark)}/streams/{uuid.uuid4().hex}"
    folder = rows.inputFiles()[0].rsplit("/", 1)[0]
    for _ in range(2):  # a second run finds nothing new
        stream_metrics(spark, folder, "user_id BIGINT, value DOUBLE", f"{base}/sink", f"{base}/checkpoint", "user_id").awaitTermination()
    return spark.read.parquet(f"{base}/sink").select("user_id", "value")

"""Queries of roll-ups, summaries, reshaping, windows and scalar functions over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from expatlas.functions import text as X
from expatlas.operators import aggregates as A
from expatlas.operators import intervals as R
from expatlas.plans.base import BRIDGE, COUNTS, bridge, counts, query
from expatlas.scratch import table


@query("""SELECT o_custkey AS group_id, coalesce(sum(l_quantity), 0) AS l_quantity, round(avg(l_discount), 8) AS l_discount, list(l_returnflag ORDER BY l_orderkey * 10 + l_linenumber, l_returnflag)[1] AS l_returnflag, max(l_tax) AS l_tax
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def a01_rollup(spark, d):
    x = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).withColumn("item_id", F.col("l_orderkey") * 10 + F.col("l_linenumber")).withColumnRenamed("o_custkey", "group_id")
    return A.rollup(x, "group_id", {"l_quantity": "sum", "l_discount": lambda c: F.round(F.avg(c), 8), "l_returnflag": "first", "l_tax": "max"})


@query("SELECT l_suppkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1")
def a02_sum_by(spark, d):
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("quantity"))


@query("SELECT c_custkey, coalesce(sum(o_totalprice) FILTER (o_orderstatus = 'P'), 0) AS o_totalprice FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def a03_sum_or_zero(spark, d):
    o = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return A.sum_or_zero(o, "c_custkey", "o_totalprice", F.col("o_orderstatus") == "P", table(spark, d, "customer"))


@query(f"WITH {BRIDGE} SELECT group_id, count(*) AS items FROM bridge WHERE libsize > 100000 GROUP BY 1")
def a04_items_per_group(spark, d):
    return bridge(spark, d).filter("libsize > 100000").groupBy("group_id").agg(F.count("*").alias("items"))


@query(f"WITH {BRIDGE} SELECT size, count(*) AS groups FROM (SELECT count(*) AS size FROM bridge GROUP BY group_id) GROUP BY 1")
def a05_group_size_hist(spark, d):
    return A.group_size_hist(bridge(spark, d), "group_id")


@query("SELECT o_orderpriority, count(*) AS n, format('{:,}', count(*)) AS text FROM orders GROUP BY 1")
def a06_value_counts(spark, d):
    return A.value_counts(table(spark, d, "orders"), "o_orderpriority")


@query("SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def a07_nunique_by(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.count_distinct("l_suppkey").alias("suppliers"), F.count_distinct("l_partkey").alias("parts"))


@query("SELECT l_returnflag, min(l_quantity) AS min, median(l_quantity) AS median, max(l_quantity) AS max, (SELECT l_quantity FROM lineitem b WHERE b.l_returnflag = a.l_returnflag GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode FROM lineitem a GROUP BY 1")
def a08_summary_stats(spark, d):
    return A.summary_stats(table(spark, d, "lineitem"), "l_quantity", ["l_returnflag"])


@query("SELECT count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS q2, round(quantile_cont(value, 0.75), 6) AS q3, max(value) AS max FROM events")
def a09_describe(spark, d):
    x = A.describe(table(spark, d, "events"), "value")
    return x.select(*[F.round(c, 6).alias(c) if c in ("mean", "std", "q1", "q2", "q3") else F.col(c) for c in x.columns])


@query("SELECT event_type, round(quantile_cont(value, 0.05), 6) AS p05, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY 1")
def a10_percentiles(spark, d):
    x = A.percentile_columns(table(spark, d, "events"), "value", {0.05: "p05", 0.95: "p95"}, ["event_type"])
    return x.select("event_type", F.round("p05", 6).alias("p05"), F.round("p95", 6).alias("p95"))


@query("SELECT user_id, round(median(value), 6) AS median, round(stddev_samp(value), 6) AS std, round(avg(value), 6) AS mean FROM events GROUP BY 1")
def a11_stat_by(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.round(F.median("value"), 6).alias("median"), F.round(F.stddev_samp("value"), 6).alias("std"), F.round(F.avg("value"), 6).alias("mean"))


@query("SELECT lang, count(*) FILTER (quality = 0) AS \"0\", count(*) FILTER (quality = 1) AS \"1\" FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def a12_crosstab(spark, d):
    return A.crosstab(table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id"), "lang", "quality", [0, 1])


@query("SELECT conv_id, min(text) FILTER (turn = 0) AS first, min(text) FILTER (turn = 1) AS second FROM conversations GROUP BY 1")
def a13_pivot_first(spark, d):
    x = table(spark, d, "conversations").groupBy("conv_id").pivot("turn", [0, 1]).agg(F.min("text"))
    return x.withColumnsRenamed({"0": "first", "1": "second"})


@query("SELECT p_partkey, 'p_size' AS name, CAST(p_size AS DOUBLE) AS value FROM part UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part")
def a14_unpivot(spark, d):
    x = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    return x.unpivot("p_partkey", ["p_size", "p_retailprice"], "name", "value")


_WIDE = "wide AS (SELECT user_id, coalesce(sum(value) FILTER (event_type = 'click'), 0) AS click, coalesce(sum(value) FILTER (event_type = 'view'), 0) AS view, coalesce(sum(value) FILTER (event_type = 'error'), 0) AS error FROM events GROUP BY 1)"


def _wide(spark, d):
    return table(spark, d, "events").groupBy("user_id").pivot("event_type", ["click", "view", "error"]).sum("value").fillna(0)


@query(f"WITH {_WIDE} SELECT user_id, round(click / (click + view + error), 8) AS click, round(view / (click + view + error), 8) AS view, round(error / (click + view + error), 8) AS error FROM wide WHERE click + view + error > 0")
def a15_row_share(spark, d):
    x = A.row_share(_wide(spark, d).filter("click + view + error > 0"), ["click", "view", "error"])
    return x.select("user_id", *[F.round(c, 8).alias(c) for c in ("click", "view", "error")])


@query(f"WITH {_WIDE} SELECT user_id, CASE WHEN click >= view AND click >= error THEN 'click' WHEN view >= error THEN 'view' ELSE 'error' END AS majority FROM wide")
def a16_majority_column(spark, d):
    return A.majority_column(_wide(spark, d), "user_id", ["click", "view", "error"])


@query(f"WITH {_WIDE} SELECT count(*) FILTER (click > 0) AS click, count(*) FILTER (view > 0) AS view, count(*) FILTER (error > 0) AS error FROM wide")
def a17_positive_counts(spark, d):
    return A.positive_counts(_wide(spark, d), ["click", "view", "error"])


@query("SELECT conv_id, arg_min(text, turn) AS opening, list_sort(list(DISTINCT role)) AS roles, count(*) AS turns FROM conversations GROUP BY 1")
def a18_group_docs(spark, d):
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.min_by("text", "turn").alias("opening"), F.array_sort(F.collect_set("role")).alias("roles"), F.count("*").alias("turns"))


@query("SELECT split_part(c_name, '#', 1) || ' ' || c_mktsegment AS person, count(*) AS n FROM customer GROUP BY 1")
def a19_count_people(spark, d):
    return table(spark, d, "customer").groupBy(F.concat_ws(" ", F.split("c_name", "#")[0], "c_mktsegment").alias("person")).agg(F.count("*").alias("n"))


_SIGNED = "signed AS (SELECT user_id, value - 20 AS v FROM events)"


@query(f"WITH {_SIGNED} SELECT user_id, count(DISTINCT sign(v)) = 1 AS consistent FROM signed GROUP BY 1")
def a20_consistent_within(spark, d):
    return A.consistent_within(table(spark, d, "events").select("user_id", (F.col("value") - 20).alias("v")), "user_id", "v")


@query(f"WITH {_SIGNED} SELECT user_id, min(v) AS low, max(v) AS high FROM signed GROUP BY 1 HAVING min(v) < 0 AND max(v) > 0")
def a21_sign_conflicts(spark, d):
    return A.sign_conflicts(table(spark, d, "events").select("user_id", (F.col("value") - 20).alias("v")), "user_id", "v")


@query(f"WITH {COUNTS} SELECT group_id, CAST(sum(count) AS BIGINT) AS total, avg(CASE WHEN count > 0 THEN 1 ELSE 0 END) * 100 AS pct_on, count(*) AS features, round(ln(1 + stddev_samp(count)), 6) AS log_std FROM counts GROUP BY 1")
def a22_count_summary(spark, d):
    return A.count_summary(counts(spark, d)).withColumn("log_std", F.round("log_std", 6))


@query("SELECT l_suppkey, round(sum(l_discount + l_tax) / sum(l_quantity) * 100, 6) AS pct FROM lineitem GROUP BY 1")
def a23_screen_summary(spark, d):
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.round(F.sum(F.col("l_discount") + F.col("l_tax")) / F.sum("l_quantity") * 100, 6).alias("pct"))


_COVER = "cover AS (SELECT user_id, CAST(event_id % 101 AS INTEGER) AS p, sum(CAST(value AS DECIMAL(18,2))) AS v FROM events GROUP BY ALL)"


@query(f"WITH {_COVER} SELECT user_id, CAST(coalesce(sum(v) FILTER (p < 33), 0) AS DOUBLE) AS five, CAST(coalesce(sum(v) FILTER (p >= 33 AND p < 68), 0) AS DOUBLE) AS middle, CAST(coalesce(sum(v) FILTER (p >= 68), 0) AS DOUBLE) AS three FROM cover GROUP BY 1")
def a24_coverage_tertiles(spark, d):
    from expatlas.sources.reports import histogram_wide

    x = table(spark, d, "events").groupBy(F.col("user_id").alias("sample"), (F.col("event_id") % 101).cast("int").alias("position")).agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("coverage"))
    parts = A.coverage_tertiles(F.col("coverage"))
    return histogram_wide(x).select(F.col("sample").alias("user_id"), *[F.round(c, 2).alias(n) for c, n in zip(parts, ("five", "middle", "three"), strict=True)])


@query("""WITH y AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1),
    s AS (SELECT CAST(unnest(generate_series((SELECT min(year) FROM y), (SELECT max(year) FROM y))) AS INTEGER) AS year)
    SELECT s.year, coalesce(n, 0) AS n, CAST(sum(coalesce(n, 0)) OVER (ORDER BY s.year) AS BIGINT) AS total FROM s LEFT JOIN y USING (year)""")
def a25_yearly_counts(spark, d):
    return A.yearly_counts(table(spark, d, "orders"), "o_orderdate")


@query(f"WITH {BRIDGE} SELECT group_id, CAST(sum(CAST(libsize AS DECIMAL(18,2))) AS DOUBLE) AS libsize FROM bridge GROUP BY 1")
def a26_libsize_by_group(spark, d):
    return bridge(spark, d).groupBy("group_id").agg(F.sum(F.col("libsize").cast("decimal(18,2)")).cast("double").alias("libsize"))


@query(f"WITH {BRIDGE} SELECT DISTINCT group_id, first_value(item_id) OVER (PARTITION BY group_id ORDER BY libsize DESC, item_id) AS largest, first_value(item_id) OVER (PARTITION BY group_id ORDER BY libsize, item_id) AS smallest FROM bridge")
def a27_extremes(spark, d):
    return A.extremes(bridge(spark, d), "group_id", "item_id", "libsize")


@query("SELECT c_custkey, label, votes, CASE WHEN votes >= 5 THEN 'unanimous' WHEN votes >= 3 THEN 'common' ELSE 'problem' END AS status FROM (SELECT o_custkey AS c_custkey, o_orderstatus AS label, count(*) AS votes FROM orders GROUP BY o_custkey, o_orderstatus QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderstatus) = 1)")
def a29_vote_consensus(spark, d):
    return A.vote_consensus(table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("label")), "c_custkey", "label", 5, 3)


@query("SELECT CAST(l_suppkey % 5 AS VARCHAR) AS a, l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS total, count(*) AS rows, max(nullif(l_returnflag, 'N')) IS NOT NULL AS known, CAST(sum(l_quantity) AS BIGINT) || '(' || count(*) || ')' AS label FROM lineitem GROUP BY 1, 2")
def a31_junction_rollup(spark, d):
    x = table(spark, d, "lineitem").select((F.col("l_suppkey") % 5).cast("string").alias("Site1_chr"), F.col("l_suppkey").alias("Site1_location"), (F.col("l_suppkey") % 5).cast("string").alias("Site2_chr"), F.col("l_suppkey").alias("Site2_location"), F.nullif("l_returnflag", F.lit("N")).alias("PrimaryGene"), F.col("l_quantity").cast("long").alias("count"))
    return A.junction_rollup(x).select(F.col("Site1_chr").alias("a"), F.col("Site1_location").alias("l_suppkey"), "total", "rows", "known", "label")


@query("WITH c AS (SELECT p_partkey AS component, p_retailprice / sum(p_retailprice) OVER () AS ratio FROM part), s AS (SELECT sum(ratio) OVER (ORDER BY ratio DESC, component) AS t FROM c) SELECT count(*) FILTER (t < 0.99) AS below_99, count(*) FILTER (t < 0.9) AS below_90, count(*) FILTER (t < 0.85) AS below_85, count(*) FILTER (t < 0.8) AS below_80 FROM s")
def w02_variance_thresholds(spark, d):
    p = table(spark, d, "part")
    total = p.agg(F.sum("p_retailprice").alias("_t"))
    return A.variance_thresholds(p.join(F.broadcast(total)).select(F.col("p_partkey").alias("component"), (F.col("p_retailprice") / F.col("_t")).alias("ratio")), [0.99, 0.9, 0.85, 0.8])


@query("SELECT o_orderkey, rank() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_orderstatus, o_totalprice) - 1) / 2 AS rank FROM orders")
def w03_rank_average(spark, d):
    return A.rank_average_ranged(table(spark, d, "orders"), ["o_orderstatus"], "o_totalprice").select("o_orderkey", "rank")


@query("SELECT o_orderkey, printf('SEG%06d', row_number() OVER (ORDER BY o_orderdate, o_orderkey)) AS id FROM orders")
def w05_sequence_ids(spark, d):
    return A.sequence_ids(table(spark, d, "orders").select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], "SEG%06d").select("o_orderkey", "id")


@query(f"WITH {COUNTS} SELECT group_id, feature_id, CAST(sum(count) OVER (PARTITION BY group_id) AS BIGINT) AS total FROM counts")
def w06_with_group_total(spark, d):
    from pyspark.sql import Window

    return counts(spark, d).select("group_id", "feature_id", F.sum("count").over(Window.partitionBy("group_id")).alias("total"))


@query("WITH x AS (SELECT user_id, event_id * 10 AS s, event_id * 10 + CAST(floor(value) AS BIGINT) AS e FROM events), n AS (SELECT user_id, e + 1 AS gap_start, lead(s) OVER (PARTITION BY user_id ORDER BY s, e) - 1 AS gap_end FROM x) SELECT * FROM n WHERE gap_start <= gap_end")
def w08_gaps_between(spark, d):
    x = table(spark, d, "events").select("user_id", (F.col("event_id") * 10).alias("s"), (F.col("event_id") * 10 + F.floor("value")).alias("e"))
    return R.gaps_between(x, "user_id", "s", "e")


@query("SELECT event_id, round((value - avg(value) OVER w) / stddev_samp(value) OVER w, 6) AS z FROM events WINDOW w AS (PARTITION BY event_type)")
def w09_zscore(spark, d):
    return A.zscore(table(spark, d, "events"), ["event_type"], "value").select("event_id", F.round("z", 6).alias("z"))


@query("SELECT doc_id, trim(replace(replace(lower(text), '.', ' '), 'the', 'THE')) AS t FROM documents")
def f01_clean_text(spark, d):
    return table(spark, d, "documents").select("doc_id", X.clean_text(F.col("text"), [(".", " "), ("the", "THE")]).alias("t"))


@query("SELECT doc_id, replace(replace(replace(text, 'the', 'in'), 'in', 'of'), 'of', 'x') AS t FROM documents")
def f02_replace_phrases(spark, d):
    return table(spark, d, "documents").select("doc_id", X.replace_phrases(F.col("text"), [("the", "in"), ("in", "of"), ("of", "x")]).alias("t"))


@query("SELECT doc_id, replace(replace(replace(replace(text, 'on', chr(1)), 'an', chr(2)), chr(1), 'an'), chr(2), 'on') AS t FROM documents")
def f03_replace_once(spark, d):
    return table(spark, d, "documents").select("doc_id", X.replace_once(F.col("text"), {"on": "an", "an": "on"}).alias("t"))


@query("SELECT page_id, regexp_extract(url, '//([^/]+)/', 1) AS host, len(regexp_extract_all(html, '<p>')) AS paragraphs FROM pages")
def f04_regex(spark, d):
    return table(spark, d, "pages").select("page_id", F.regexp_extract("url", "//([^/]+)/", 1).alias("host"), F.regexp_count("html", F.lit("<p>")).cast("long").alias("paragraphs"))


@query("SELECT item_id, list_filter(regexp_extract_all(text, '[a-zA-Z-]+'), lambda w: len(w) > 1 AND w NOT IN ('the', 'of')) AS words FROM benchmark")
def f05_tokens(spark, d):
    return table(spark, d, "benchmark").select("item_id", X.tokens(F.col("text"), "[a-zA-Z-]+", ["the", "of"]).alias("words"))


@query("SELECT p_partkey, p_name LIKE '%ring%' AS has_ring, starts_with(p_type, 'ECO') AS eco FROM part")
def f06_contains(spark, d):
    return table(spark, d, "part").select("p_partkey", F.col("p_name").contains("ring").alias("has_ring"), F.startswith("p_type", F.lit("ECO")).alias("eco"))


@query("SELECT doc_id, trim(w) AS w, lpad(CAST(doc_id AS VARCHAR), 8, '0') AS padded FROM (SELECT doc_id, unnest(string_split(text, '|')) AS w FROM documents WHERE contains(text, '|'))")
def f07_split_bars(spark, d):
    x = table(spark, d, "documents").filter("text like '%|%'").select("doc_id", F.explode(X.split_bars(F.col("text"))).alias("w"))
    return x.select("doc_id", F.trim("w").alias("w"), F.lpad(F.col("doc_id").cast("string"), 8, "0").alias("padded"))


@query("SELECT c_custkey, c_mktsegment || ' ' || c_name || CASE WHEN c_acctbal > 0 THEN ' <' || c_nationkey || '>' ELSE '' END AS person FROM customer")
def f08_person(spark, d):
    return table(spark, d, "customer").select("c_custkey", X.person(F.col("c_mktsegment"), F.col("c_name"), F.when(F.col("c_acctbal") > 0, F.col("c_nationkey").cast("string"))).alias("person"))


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(o_orderdate AS DATE) AS day FROM orders")
def f10_dates(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"), F.to_date("o_orderdate").alias("day"))


@query("SELECT event_id, round(log2(value + 1), 8) AS l2, round(log10(value + 1), 8) AS l10, round(ln(value + 1), 8) AS l, round(sqrt(value), 8) AS root, ceil(value) AS up FROM events")
def f11_math(spark, d):
    v = F.col("value")
    return table(spark, d, "events").select("event_id", F.round(F.log2(v + 1), 8).alias("l2"), F.round(F.log10(v + 1), 8).alias("l10"), F.round(F.log1p(v), 8).alias("l"), F.round(F.sqrt(v), 8).alias("root"), F.ceil(v).cast("double").alias("up"))


@query("SELECT event_id, CASE WHEN value > 0 AND value <= 10 THEN 'low' WHEN value > 10 AND value <= 100 THEN 'mid' WHEN value > 100 AND value <= 1000 THEN 'high' END AS bin FROM events")
def f12_cut(spark, d):
    return table(spark, d, "events").select("event_id", X.cut_left_open(F.col("value"), [0, 10, 100, 1000], ["low", "mid", "high"]).alias("bin"))


@query("SELECT p_partkey, CAST(least(floor((p_size - 1) / 49.0 * 7) + 1, 7) AS BIGINT) AS bin FROM part")
def f13_equal_bins(spark, d):
    return table(spark, d, "part").select("p_partkey", X.equal_bins(F.col("p_size").cast("double"), 1.0, 50.0, 7).cast("long").alias("bin"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def f14_json_map(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "map<string,bigint>")["k"].alias("k"))


@query("SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS lines FROM conversations GROUP BY 1")
def f15_attribute_lines(spark, d):
    x = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.col("role").alias("name"), F.col("text").alias("value")))).alias("a"))
    return x.select("conv_id", X.attribute_lines(F.col("a")).alias("lines"))


@query("SELECT o_orderkey, CAST(o_orderstatus = 'O' AS INTEGER) AS open FROM orders")
def f16_on_flag(spark, d):
    return table(spark, d, "orders").select("o_orderkey", X.on_flag(F.when(F.col("o_orderstatus") == "O", "on")).alias("open"))


@query("SELECT doc_id, md5(text) AS md5 FROM documents")
def f17_md5(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5("text").alias("md5"))


@query("SELECT o_orderkey, CASE WHEN log10(o_totalprice) <= 3 THEN 'small' WHEN log10(o_totalprice) <= 6 THEN 'medium' WHEN log10(o_totalprice) <= 7 THEN 'large' ELSE 'huge' END AS tier FROM orders")
def f18_resource_tier(spark, d):
    return table(spark, d, "orders").select("o_orderkey", X.resource_tier(F.col("o_totalprice")).alias("tier"))

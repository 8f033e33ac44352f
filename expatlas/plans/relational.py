"""Queries of filters, joins, set algebra, order and samples over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from expatlas.operators import relational as R
from expatlas.plans.base import BRIDGE, COUNTS, bridge, counts, query
from expatlas.scratch import table

_RUNS = "runs AS (SELECT o_orderkey AS item_id, o_custkey AS group_id, CASE o_orderstatus WHEN 'O' THEN 'PE' WHEN 'F' THEN 'keep_R2' ELSE 'SE' END AS layout, o_totalprice AS r1, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice * 0.75 + 40000 END AS r2 FROM orders)"


def runs(spark, d):
    o = table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("item_id"), F.col("o_custkey").alias("group_id"), F.when(F.col("o_orderstatus") == "O", "PE").when(F.col("o_orderstatus") == "F", "keep_R2").otherwise("SE").alias("layout"), F.col("o_totalprice").alias("r1"), F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") * 0.75 + 40000).alias("r2"))


@query("SELECT event_id, user_id FROM events WHERE event_type = 'click' AND value > 100")
def s02_scan_pushdown(spark, d):
    return table(spark, d, "events").filter((F.col("event_type") == "click") & (F.col("value") > 100)).select("event_id", "user_id")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def p01_keep_rows(spark, d):
    return R.keep_rows(table(spark, d, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"]).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') OR o_orderpriority IS NULL")
def p01_remove_rows(spark, d):
    return R.remove_rows(table(spark, d, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"]).select("o_orderkey")


@query("SELECT conv_id, t.turn AS turn, t.role AS role FROM (SELECT conv_id, unnest(list({'turn': turn, 'role': role})) AS t FROM conversations GROUP BY conv_id)")
def p02_unwind(spark, d):
    nested = table(spark, d, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role")).alias("turns"))
    return R.unwind(nested, "turns", "t").select("conv_id", "t.turn", "t.role")


@query("SELECT CAST(o_custkey AS VARCHAR) AS srx, CAST(o_orderkey AS VARCHAR) AS srr, CAST(floor(o_totalprice) AS BIGINT) AS libsize FROM orders WHERE floor(o_totalprice) > 100000")
def p03_build_bridge(spark, d):
    run = F.struct(F.col("o_orderkey").cast("string").alias("srr"), F.floor("o_totalprice").cast("string").alias("nspots"))
    catalog = table(spark, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("srx")).agg(F.collect_list(run).alias("runs"))
    return R.build_bridge(catalog)


@query("SELECT o_orderkey FROM orders WHERE (o_orderstatus <> 'F' AND o_totalprice > 1000 AND o_totalprice <= 200000) OR regexp_matches(o_orderpriority, '^[12]')")
def p04_predicates(spark, d):
    o = table(spark, d, "orders")
    return o.filter(((F.col("o_orderstatus") != "F") & (F.col("o_totalprice") > 1000) & (F.col("o_totalprice") <= 200000)) | F.col("o_orderpriority").rlike("^[12]")).select("o_orderkey")


@query("SELECT event_id, CASE WHEN event_type = 'click' THEN 0.0::DOUBLE ELSE value END AS v FROM events")
def p05_clean_number(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", R.clean_number(F.when(F.col("event_type") == "click", "").otherwise(F.col("value").cast("string"))).alias("v"))


@query(f"WITH {_RUNS} SELECT item_id FROM runs WHERE (coalesce(r1, 0) > 0 OR coalesce(r2, 0) > 0) AND coalesce(r1, 0) <= 60000 AND coalesce(r2, 0) <= 60000")
def p06_too_few_reads(spark, d):
    return runs(spark, d).filter(R.too_few_reads([F.col("r1"), F.col("r2")], 60000)).select("item_id")


@query("SELECT p_partkey FROM part WHERE p_size > 0 AND p_size < 25")
def p06_too_short_reads(spark, d):
    return table(spark, d, "part").filter(R.too_short_reads([F.col("p_size")], 25)).select("p_partkey")


@query("SELECT user_id, CAST(bool_or(event_type = 'error') AS INTEGER) AS error, CAST(bool_or(event_type = 'signup') AS INTEGER) AS signup FROM events WHERE value > 200 GROUP BY user_id")
def p07_flags_from_array(spark, d):
    flags = table(spark, d, "events").filter("value > 200").groupBy("user_id").agg(F.collect_set("event_type").alias("flags"))
    return R.flags_from_array(flags, "flags", ["error", "signup"]).drop("flags")


@query("SELECT r_regionkey AS regionkey, r_name AS name FROM region")
def p08_rename_cols(spark, d):
    return R.rename_cols(table(spark, d, "region"), lambda c: c.removeprefix("r_").lower())


@query("SELECT l_orderkey, l_linenumber, l_discount * 100 AS pct_discount, l_tax * 100 AS pct_tax FROM lineitem")
def p09_to_percent(spark, d):
    return R.to_percent(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_discount").alias("pct_discount"), F.col("l_tax").alias("pct_tax")))


@query(f"WITH {_RUNS} SELECT item_id, greatest(r1, r2) AS libsize FROM runs")
def p10_greatest_of(spark, d):
    return R.greatest_of(runs(spark, d), ["r1", "r2"], "libsize").select("item_id", "libsize")


@query(f"WITH {_RUNS} SELECT item_id, CASE WHEN layout IN ('SE', 'keep_R1') THEN r1 WHEN layout = 'keep_R2' THEN r2 ELSE greatest(r1, r2) END AS libsize FROM runs")
def p11_effective_libsize(spark, d):
    return runs(spark, d).select("item_id", R.effective_libsize(F.col("layout"), F.col("r1"), F.col("r2")).alias("libsize"))


@query(f"WITH {_RUNS} SELECT CASE WHEN layout LIKE 'keep%' THEN 'PE->SE' ELSE layout END AS layout, count(*) AS n FROM runs GROUP BY 1")
def p12_canon_layout(spark, d):
    return runs(spark, d).groupBy(R.canon_layout(F.col("layout")).alias("layout")).agg(F.count("*").alias("n"))


@query(f"WITH {_RUNS} SELECT group_id, item_id FROM runs WHERE greatest(r1, r2) >= 100000")
def p13_qc_libsize(spark, d):
    return R.qc_libsize(runs(spark, d), ["r1", "r2"], ["group_id", "item_id"])


@query("SELECT p_partkey FROM part WHERE p_size >= 30")
def p13_qc_readlen(spark, d):
    return R.qc_readlen(table(spark, d, "part"), ["p_size"], ["p_partkey"])


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linestatus IN ('O', 'F') AND l_quantity > 0 AND (l_discount * 100) / l_quantity <= 0.5")
def p14_qc_mappability(spark, d):
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", F.col("l_quantity").alias("reads"), (F.col("l_discount") * 100).alias("unaligned"))
    return R.qc_mappability(x.filter("l_linestatus = 'O'"), x.filter("l_linestatus = 'F'"), ["l_orderkey", "l_linenumber"])


@query("SELECT user_id, max(value) AS percent FROM events WHERE event_type = 'purchase' GROUP BY user_id HAVING max(value) >= 200")
def p15_qc_contamination(spark, d):
    e = table(spark, d, "events").select("user_id", F.col("event_type").alias("reference"), F.col("value").alias("percent"))
    return R.qc_contamination(e, ["user_id"], "purchase", 200)


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity / 50 >= 0.75 THEN 'first' WHEN 1 - l_quantity / 50 >= 0.75 THEN 'second' ELSE 'unstranded' END AS strand FROM lineitem")
def p16_qc_strand(spark, d):
    share = F.col("l_quantity") / 50
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", R.strand_label(share, 1 - share).alias("strand"))


@query("SELECT s, count(*) AS n FROM (SELECT CASE WHEN x >= 0.95 THEN 2 WHEN x <= 1 - 0.95 THEN -2 WHEN x >= 0.75 THEN 1 WHEN x <= 1 - 0.75 THEN -1 ELSE 0 END AS s FROM (SELECT l_quantity / 50 AS x FROM lineitem)) GROUP BY s")
def p17_strand_indicator(spark, d):
    return table(spark, d, "lineitem").groupBy(R.strand_indicator(F.col("l_quantity") / 50).alias("s")).agg(F.count("*").alias("n"))


@query("SELECT count(*) FILTER (x >= 75) AS first, count(*) FILTER (x < 75 AND x > 25) AS unstranded, count(*) FILTER (x <= 25) AS second FROM (SELECT l_quantity * 2 AS x FROM lineitem)")
def p18_strand_counts(spark, d):
    return R.strand_counts(table(spark, d, "lineitem").select((F.col("l_quantity") * 2).alias("x")), "x")


@query("SELECT l_orderkey, l_linenumber, l_discount >= 0.05 AS flag_l_discount, l_tax >= 0.01 AS flag_l_tax FROM lineitem")
def p19_contaminant_flags(spark, d):
    return R.contaminant_flags(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax"), {"l_discount": 0.05, "l_tax": 0.01}).drop("l_discount", "l_tax")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE greatest(l_discount, l_tax) >= 0.08")
def p20_any_contaminant(spark, d):
    return table(spark, d, "lineitem").filter(R.any_contaminant(["l_discount", "l_tax"], 0.08)).select("l_orderkey", "l_linenumber")


@query("SELECT p_partkey, p_size < 10 AS short FROM part")
def p21_flag_below(spark, d):
    return R.flag_below(table(spark, d, "part"), "p_size", 10, "short").select("p_partkey", "short")


@query("SELECT CASE WHEN l < 25 THEN 'under_25' WHEN l < 45 THEN 'under_45' WHEN l < 160 THEN 'under_160' WHEN l < 300 THEN 'under_300' ELSE 'from_300' END AS class, count(*) AS n FROM (SELECT value AS l FROM events) GROUP BY 1")
def p22_length_classes(spark, d):
    return table(spark, d, "events").groupBy(R.length_class(F.col("value")).alias("class")).agg(F.count("*").alias("n"))


@query("SELECT event_id, value >= 100 AS ok FROM events")
def p23_gate(spark, d):
    ok, bad = R.gate(table(spark, d, "events"), F.col("value") >= 100)
    return ok.select("event_id", F.lit(True).alias("ok")).union(bad.select("event_id", F.lit(False).alias("ok")))


@query("SELECT l_orderkey, l_linenumber FROM lineitem, (SELECT quantile_cont(l_quantity, 0.5) AS q, quantile_cont(l_discount, 0.5) AS s FROM lineitem) WHERE l_quantity >= q AND l_discount <= s")
def p24_percentile_gate(spark, d):
    return R.percentile_gate(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"), ["l_quantity"], ["l_discount"]).select("l_orderkey", "l_linenumber")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_suppkey % 5 = l_partkey % 5 AND CAST(l_suppkey % 5 AS VARCHAR) IN ('0', '1', '2')) OR (abs(l_partkey - l_suppkey) > 500 AND l_returnflag <> 'N')")
def p25_filter_junctions(spark, d):
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 5).cast("string").alias("Site1_chr"), (F.col("l_partkey") % 5).cast("string").alias("Site2_chr"), F.col("l_suppkey").alias("Site1_location"), F.col("l_partkey").alias("Site2_location"), F.nullif("l_returnflag", F.lit("N")).alias("PrimaryGene"))
    return R.filter_junctions(x, ["0", "1", "2"]).select("l_orderkey", "l_linenumber")


@query(f"WITH {_RUNS} SELECT item_id FROM runs WHERE r1 IS NOT NULL AND r2 IS NOT NULL")
def p26_dropna(spark, d):
    return runs(spark, d).dropna().select("item_id")


@query(f"WITH {_RUNS} SELECT item_id, round(coalesce(r2, (SELECT avg(r2) FROM runs)), 4) AS r2 FROM runs")
def p27_fill_mean(spark, d):
    return R.fill_mean(runs(spark, d), ["r2"]).select("item_id", F.round("r2", 4).alias("r2"))


@query("SELECT p_partkey, CASE WHEN count(*) OVER (PARTITION BY p_name) < 20 THEN 'OTHER' ELSE p_name END AS p_name FROM part")
def p28_collapse_rare(spark, d):
    return R.collapse_rare(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", 20)


@query("SELECT n_name, CAST(NULL AS VARCHAR) AS missing FROM nation")
def p29_reindex_cols(spark, d):
    return R.reindex_cols(table(spark, d, "nation"), ["n_name", "missing"])


@query("SELECT o_orderkey FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'")
def j01_qc_passed(spark, d):
    o = table(spark, d, "orders")
    return R.qc_passed(["o_orderkey"], o.filter("o_totalprice > 100000"), o.filter("o_orderstatus = 'O'"), o.filter("o_orderpriority = '1-URGENT'"))


@query("SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 300000 GROUP BY c_custkey")
def j02_join_left(spark, d):
    big = table(spark, d, "orders").filter("o_totalprice > 300000")
    return table(spark, d, "customer").join(big, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"))


@query("SELECT coalesce(a.k, b.k) AS k, a.n AS customers, b.n AS suppliers FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 9900 GROUP BY 1) a FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) b ON a.k = b.k")
def j03_join_outer(spark, d):
    a = table(spark, d, "customer").filter("c_acctbal > 9900").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("customers"))
    b = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers"))
    return a.join(b, "k", "outer")


def _per_user(spark, d, kind):
    return table(spark, d, "events").filter(F.col("event_type") == kind).groupBy("user_id").agg(F.max("value").alias(kind))


@query("SELECT user_id, max(value) FILTER (event_type = 'click') AS click, max(value) FILTER (event_type = 'view') AS view, max(value) FILTER (event_type = 'error') AS error FROM events WHERE event_type IN ('click', 'view', 'error') GROUP BY user_id")
def j04_align_outer(spark, d):
    return R.align_outer("user_id", *[_per_user(spark, d, k) for k in ("click", "view", "error")])


@query("SELECT * FROM (SELECT user_id, max(value) FILTER (event_type = 'click') AS click, max(value) FILTER (event_type = 'view') AS view FROM events GROUP BY user_id) WHERE click IS NOT NULL AND view IS NOT NULL")
def j05_align_inner(spark, d):
    return R.align_inner("user_id", *[_per_user(spark, d, k) for k in ("click", "view")])


@query("SELECT c_custkey AS group_id, sum(o_totalprice) AS total FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') ON c_custkey = o_custkey GROUP BY 1")
def j06_reindex(spark, d):
    sums = table(spark, d, "orders").filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("group_id")).agg(F.sum("o_totalprice").alias("total"))
    return R.reindex(sums, table(spark, d, "customer").select(F.col("c_custkey").alias("group_id")), ["group_id"])


@query("SELECT c_custkey, n_name AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def j07_map_values(spark, d):
    return R.map_values(table(spark, d, "customer"), "c_nationkey", table(spark, d, "nation"), "n_nationkey", "n_name", "nation").select("c_custkey", "nation")


@query("SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def j08_semi(spark, d):
    return R.semi(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").filter("quality = 1"), "doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j09_anti(spark, d):
    return R.anti(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id")


@query(f"WITH {BRIDGE} SELECT a.group_id, a.item_id AS item_a, b.item_id AS item_b FROM bridge a JOIN bridge b ON a.group_id = b.group_id AND a.item_id < b.item_id")
def j10_pairs_within(spark, d):
    return R.pairs_within(bridge(spark, d), "group_id", "item_id")


@query("SELECT o_orderkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def j12_attach_labels(spark, d):
    return table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_mktsegment")


@query("SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def u01_union_all(spark, d):
    return R.union_all(table(spark, d, "customer").select(F.col("c_nationkey").alias("k")), table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")))


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def u02_union_distinct(spark, d):
    return R.union_distinct(table(spark, d, "customer").select(F.col("c_nationkey").alias("k")), table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")))


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders")
def u03_except_ids(spark, d):
    return R.anti(table(spark, d, "customer").select(F.col("c_custkey").alias("k")), table(spark, d, "orders").select(F.col("o_custkey").alias("k")), "k").distinct()


@query("SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders")
def u04_intersect_ids(spark, d):
    return R.semi(table(spark, d, "customer").select(F.col("c_custkey").alias("k")), table(spark, d, "orders").select(F.col("o_custkey").alias("k")), "k").distinct()


@query(f"""WITH {BRIDGE} SELECT group_id, item_id, libsize FROM bridge
    WHERE group_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) AND item_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
      AND group_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') ORDER BY item_id LIMIT 200""")
def u05_work_list(spark, d):
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    groups = lambda rule: c.filter(rule).select(F.concat(F.lit(""), F.col("c_custkey").cast("string")).alias("id"))
    b = bridge(spark, d).select(F.concat(F.lit("G"), F.col("group_id")).alias("group_id"), F.concat(F.lit("I"), F.col("item_id")).alias("item_id"), "libsize")
    name = lambda df, p: df.select(F.concat(F.lit(p), F.col("id")).alias("id"))
    found = R.work_list(b, completed=name(groups("c_acctbal < 0"), "G"), problems=name(o.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("id")), "I"), subset=name(groups("c_mktsegment = 'BUILDING'"), "G"), size=200)
    return found.select(F.substring("group_id", 2, 20).cast("long").alias("group_id"), F.substring("item_id", 2, 20).cast("long").alias("item_id"), "libsize")


@query("SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 0.0::DOUBLE ELSE c_acctbal END AS c_acctbal FROM customer")
def u06_upsert(spark, d):
    base = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return R.upsert(base, table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select("c_custkey", F.lit(0.0).alias("c_acctbal")), "c_custkey")


@query("SELECT doc_id, coalesce(quality, -1) AS quality FROM documents LEFT JOIN labels USING (doc_id)")
def u07_reconcile(spark, d):
    return R.reconcile(table(spark, d, "labels").select("doc_id", "quality"), table(spark, d, "documents").select("doc_id"), "doc_id", {"quality": -1})


@query("SELECT doc_id FROM labels UNION SELECT item_id FROM benchmark")
def u08_push(spark, d):
    return R.push(table(spark, d, "labels").select("doc_id"), table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id")))


@query("SELECT doc_id FROM labels WHERE doc_id NOT IN (SELECT item_id FROM benchmark)")
def u08_pop(spark, d):
    return R.pop(table(spark, d, "labels").select("doc_id"), table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id")), "doc_id")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 250000)")
def u09_prune(spark, d):
    keep = table(spark, d, "orders").filter("o_totalprice > 250000").select(F.col("o_orderkey").alias("l_orderkey"))
    return R.semi(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), keep, "l_orderkey")


@query(f"WITH {BRIDGE} SELECT group_id, list_sort(list(DISTINCT item_id)) AS partners FROM bridge GROUP BY group_id")
def u10_partners(spark, d):
    return R.partners(bridge(spark, d), "group_id", "item_id")


@query("SELECT c_custkey, c_name FROM customer ORDER BY CAST(regexp_extract(c_name, '(\\d+)', 1) AS BIGINT), c_name LIMIT 50")
def o02_take_queue(spark, d):
    return R.take_queue(table(spark, d, "customer"), "c_name", 50).select("c_custkey", "c_name")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 40")
def o03_page(spark, d):
    return R.page(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 40, 20)


@query("SELECT o_orderkey FROM orders WHERE o_totalprice < (SELECT quantile_cont(o_totalprice, 0.25) FROM orders)")
def o04_below_percentile(spark, d):
    return R.below_percentile(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 0.25).select("o_orderkey")


@query("SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT (SELECT CAST(floor(count(*) * 0.1) AS BIGINT) FROM orders)")
def o05_top_fraction(spark, d):
    return R.top_fraction(table(spark, d, "orders"), [F.desc("o_totalprice"), "o_orderkey"], 0.1).select("o_orderkey")


@query(f"WITH {COUNTS} SELECT feature_id, round(stddev_samp(count) / count(*), 6) AS dispersion FROM counts GROUP BY 1 HAVING count(*) > 1 ORDER BY stddev_samp(count) / count(*) DESC, feature_id LIMIT 20")
def o07_most_variable(spark, d):
    return R.most_variable(counts(spark, d), 20).select("feature_id", F.round("dispersion", 6).alias("dispersion"))


@query("SELECT c_mktsegment, c_custkey FROM customer QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5('7:' || c_custkey), c_custkey) <= 5")
def o08_sample_n(spark, d):
    return R.sample_n(table(spark, d, "customer").select("c_mktsegment", "c_custkey"), 5, "c_custkey", "c_mktsegment", 7)


@query("SELECT c_custkey, CAST('0x' || substr(md5('1:' || c_custkey), 1, 8) AS BIGINT) < CAST(floor(0.8 * 4294967296) AS BIGINT) AS train FROM customer")
def o09_split(spark, d):
    train, test = R.split(table(spark, d, "customer"), "c_custkey", 0.8, 1)
    return train.select("c_custkey", F.lit(True).alias("train")).union(test.select("c_custkey", F.lit(False).alias("train")))

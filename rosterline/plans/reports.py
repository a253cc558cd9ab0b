"""Queries on counts, coverage and rollups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import counts, reconcile
from ..sources.tables import table
from . import jobs
from .registry import query


@query("count_per_program", "SELECT n_nationkey, count(s_suppkey) AS n FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1")
def _(spark, d):
    suppliers = table(spark, d, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    return counts.zero_filled(table(spark, d, "nation").select("n_nationkey"), suppliers, "n_nationkey")


@query("active_counts", "SELECT o_custkey, count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'O') AS active, count(*) FILTER (WHERE o_orderstatus = 'F') AS exited FROM orders GROUP BY 1")
def _(spark, d):
    return counts.counts_by_value(table(spark, d, "orders"), ["o_custkey"], "o_orderstatus", {"O": "active", "F": "exited"}, "total")


@query("status_pivot", "SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS F, count(*) FILTER (WHERE o_orderstatus = 'O') AS O, count(*) FILTER (WHERE o_orderstatus = 'P') AS P FROM orders GROUP BY 1")
def _(spark, d):
    return counts.counts_by_value(table(spark, d, "orders"), ["o_orderpriority"], "o_orderstatus", {v: v for v in "FOP"})


@query("global_counts", "SELECT (SELECT count(*) FROM customer) AS providers, (SELECT count(DISTINCT c_nationkey) FROM customer) AS programs, (SELECT count(*) FROM orders) AS events, (SELECT count(DISTINCT n_regionkey) FROM nation) AS jurisdictions")
def _(spark, d):
    return counts.totals({
        "provider": (table(spark, d, "customer"), {"providers": F.count("*"), "programs": F.count_distinct("c_nationkey")}),
        "event": (table(spark, d, "orders"), {"events": F.count("*")}), "program": (table(spark, d, "nation"), {"jurisdictions": F.count_distinct("n_regionkey")}),
    })


@query("jurisdiction_rollup", """WITH p AS (SELECT n_nationkey, n_name, n_regionkey, count(s_suppkey) AS n FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY ALL)
SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS programs, CAST(sum(n) AS BIGINT) AS providers, bool_and(n = 0) AS all_zero, CAST(max(sum(n)) OVER () AS BIGINT) AS max_providers FROM p GROUP BY 1""")
def _(spark, d):
    p = counts.zero_filled(table(spark, d, "nation"), table(spark, d, "supplier").withColumnRenamed("s_nationkey", "n_nationkey"), "n_nationkey")
    return counts.place_rollup(p, "n_regionkey", "n_name", "n").withColumn("programs", F.array_join("programs", ","))


@query("share_of_max", "SELECT c_nationkey, count(*) AS n, round(count(*) / greatest(max(count(*)) OVER (), 1), 6) AS share FROM customer GROUP BY 1")
def _(spark, d):
    return counts.share_of_most(counts.counts_of(table(spark, d, "customer"), ["c_nationkey"]), "n")


@query("coverage_report", """WITH s AS (SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 1 ELSE 100 END AS stated FROM nation), n AS (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1)
SELECT n_nationkey, coalesce(n, 0) AS n, stated, round(coalesce(n, 0) / stated, 6) AS coverage,
CASE WHEN coalesce(n, 0) = 0 AND n_nationkey % 2 = 0 THEN 'zero_documented' WHEN stated IS NULL THEN 'no_source_total' WHEN coalesce(n, 0) >= stated THEN 'full' ELSE 'partial' END AS label FROM s LEFT JOIN n ON s_nationkey = n_nationkey""")
def _(spark, d):
    nation = table(spark, d, "nation").select("n_nationkey")
    stated = nation.withColumn("stated", F.expr("CASE n_nationkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 1 ELSE 100 END"))
    return reconcile.coverage_report(table(spark, d, "supplier").select(F.col("s_nationkey").alias("n_nationkey")), stated, "n_nationkey", nation.filter("n_nationkey % 2 = 0"))


@query("divergence", """WITH a AS (SELECT c_nationkey, count(*) AS ours FROM customer GROUP BY 1), b AS (SELECT c_nationkey, count(*) AS published FROM customer WHERE c_custkey % 10 < 8 GROUP BY 1)
SELECT c_nationkey, ours, published, round((ours - published) / published, 6) AS divergence, abs((ours - published) / published) > 0.25 AS flagged FROM a JOIN b USING (c_nationkey)""")
def _(spark, d):
    c = table(spark, d, "customer")
    count = lambda df, name: df.groupBy("c_nationkey").agg(F.count("*").alias(name))
    return reconcile.divergence(count(c, "ours"), count(c.filter("c_custkey % 10 < 8"), "published"), "c_nationkey", 0.25)


@query("fill_rate", "SELECT p_brand, round(avg(CASE WHEN contains(p_name, 'ring') THEN 1.0 ELSE 0.0 END), 6) AS rate FROM part GROUP BY 1")
def _(spark, d):
    filled = F.size(F.filter(F.split("p_name", " "), lambda w: w == "ring")) > 0
    return counts.fill_rate(table(spark, d, "part"), ["p_brand"], filled)


@query("element_freq", "SELECT w AS word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part) GROUP BY 1")
def _(spark, d):
    return counts.element_counts(table(spark, d, "part"), F.split("p_name", " "), "word")


@query("label_counter", "SELECT o_orderpriority AS label, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, label")
def _(spark, d):
    return counts.label_counts(table(spark, d, "orders"), F.col("o_orderpriority"))


@query("zero_fill_counts", "SELECT k.seg AS segment, count(c_custkey) AS n FROM (SELECT unnest(['BUILDING', 'MACHINERY', 'SPACE']) AS seg) k LEFT JOIN customer ON c_mktsegment = k.seg GROUP BY 1")
def _(spark, d):
    kinds = spark.sql("SELECT explode(array('BUILDING', 'MACHINERY', 'SPACE')) AS segment")
    return counts.zero_filled(kinds, table(spark, d, "customer").withColumnRenamed("c_mktsegment", "segment"), "segment")


@query("table_profile", "SELECT 'customer' AS table_name, (SELECT count(*) FROM customer) AS before, (SELECT count(*) FROM customer WHERE c_acctbal > 0) AS after UNION ALL SELECT 'supplier', (SELECT count(*) FROM supplier), (SELECT count(*) FROM supplier WHERE s_acctbal > 0)")
def _(spark, d):
    return counts.before_and_after({"customer": (table(spark, d, "customer"), F.col("c_acctbal") > 0), "supplier": (table(spark, d, "supplier"), F.col("s_acctbal") > 0)})


@query("ledger_state", "SELECT count(*) FILTER (WHERE quality = 1) AS resolved, count(*) FILTER (WHERE quality <> 1) AS unresolved, count(DISTINCT doc_id) AS items FROM labels")
def _(spark, d):
    return reconcile.ledger_state(table(spark, d, "labels").select((F.col("quality") == 1).alias("resolved"), F.col("doc_id").alias("item")))


@query("ledger_dispositions", "SELECT quality, toxic, count(*) AS n FROM labels GROUP BY ALL")
def _(spark, d):
    return counts.counts_of(table(spark, d, "labels"), ["quality", "toxic"])


@query("label_crosstab", "SELECT o_orderstatus AS label, CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'exited' ELSE 'unknown' END AS mapped, count(*) AS n FROM orders GROUP BY ALL")
def _(spark, d):
    from ..functions.parse import label_status

    o = table(spark, d, "orders").select(F.col("o_orderstatus").alias("label"), label_status(F.col("o_orderstatus"), {"o": "active", "f": "exited"}).alias("mapped"))
    return counts.counts_of(o, ["label", "mapped"])


@query("rollup_totals", "SELECT coalesce(o_orderstatus, 'Total') AS status, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY ROLLUP (o_orderstatus)")
def _(spark, d):
    return counts.rollup_totals(table(spark, d, "orders"), "o_orderstatus", {"n": F.count("*"), "customers": F.count_distinct("o_custkey")}, "status")


@query("top_evidence", "SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_totalprice DESC, o_orderkey) AS evidence FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 5) GROUP BY 1")
def _(spark, d):
    top = jobs.top_ranked(table(spark, d, "orders"), "o_custkey", [F.desc("o_totalprice"), F.asc("o_orderkey")], 5).groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("rank", "o_orderkey"))).alias("e"))
    return top.select("o_custkey", F.array_join(F.transform("e", lambda x: x.o_orderkey.cast("string")), ",").alias("evidence"))


@query("sort_nulls_last", "SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS balance FROM customer ORDER BY balance DESC NULLS LAST, c_custkey")
def _(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal")).alias("balance"))
    return c.orderBy(F.desc_nulls_last("balance"), "c_custkey")


@query("program_table", "SELECT n_name, n_regionkey, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey END AS launched FROM nation ORDER BY n_regionkey, launched NULLS LAST, n_name")
def _(spark, d):
    n = table(spark, d, "nation").select("n_name", "n_regionkey", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_nationkey")).alias("launched"))
    return n.orderBy("n_regionkey", F.asc_nulls_last("launched"), "n_name")

"""Queries on checks, joins, merges and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parse
from ..functions.names import normalize_name
from ..operators import counts, match, merge, quality, reconcile
from ..operators.sizes import broadcast_if_small
from ..sources.tables import table
from .expressions import TABLES
from .diffs import BASE, chain
from .registry import query


def places(spark, d):
    return table(spark, d, "customer").join(broadcast_if_small(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).join(broadcast_if_small(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))


@query("provider_filter", "SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' AND c_mktsegment = 'BUILDING' AND contains(lower(c_name || ' ' || n_name), '#0000')")
def _(spark, d):
    hit = parse.search_hit(" #0000 ", F.col("c_name"), F.col("n_name"))
    return counts.select_providers(places(spark, d), {"r_name": "ASIA", "c_mktsegment": "BUILDING"}, hit).select("c_custkey")


@query("validate_rows", """SELECT c_custkey, array_to_string(list_filter([CASE WHEN c_acctbal < 0 THEN 'balance: range' END, CASE WHEN NOT regexp_matches(c_name, '0$') THEN 'name: pattern' END, CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN 'segment: value' END], lambda x: x IS NOT NULL), ';') AS errors
FROM customer WHERE c_acctbal < 0 OR NOT regexp_matches(c_name, '0$') OR c_mktsegment NOT IN ('BUILDING', 'MACHINERY')""")
def _(spark, d):
    rules = {"balance: range": F.col("c_acctbal") >= 0, "name: pattern": F.col("c_name").rlike("0$"), "segment: value": F.col("c_mktsegment").isin("BUILDING", "MACHINERY")}
    return quality.validate(table(spark, d, "customer"), rules)[1].select("c_custkey", F.array_join("errors", ";").alias("errors"))


@query("min_rows_guard", "SELECT o_custkey, count(*) AS n_rows, CASE WHEN count(*) < 10 THEN 'too_few' ELSE 'ok' END AS verdict FROM orders GROUP BY 1")
def _(spark, d):
    return quality.count_guard(table(spark, d, "orders"), "o_custkey", least=10)


@query("ceiling_guard", "SELECT o_custkey, count(*) AS n_rows, CASE WHEN count(*) >= 20 THEN 'truncated' ELSE 'ok' END AS verdict FROM orders GROUP BY 1")
def _(spark, d):
    return quality.count_guard(table(spark, d, "orders"), "o_custkey", ceiling=20)


@query("total_guard", """WITH s AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 10 ELSE 12 END AS stated FROM customer), n AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
SELECT c_custkey, stated, coalesce(n, 0) AS n_rows, CASE WHEN stated IS NULL THEN 'unknown' WHEN stated = coalesce(n, 0) THEN 'ok' ELSE 'mismatch' END AS verdict FROM s LEFT JOIN n ON o_custkey = c_custkey""")
def _(spark, d):
    stated = table(spark, d, "customer").select("c_custkey", F.expr("CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 10 ELSE 12 END").alias("stated"))
    return quality.total_guard(table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), stated, "c_custkey")


@query("structure_guard", "SELECT page_id, array_to_string(list_filter([CASE WHEN NOT regexp_matches(html, '<article>') THEN 'article' END, CASE WHEN NOT regexp_matches(html, '</body>') THEN 'end' END], lambda x: x IS NOT NULL), ',') AS missing FROM pages")
def _(spark, d):
    return quality.structure_guard(table(spark, d, "pages"), "page_id", "html", {"article": "<article>", "end": "</body>"}).withColumn("missing", F.array_join("missing", ","))


HOST = "regexp_extract(url, '//([^/]*)', 1)"


@query("roster_url_filter", f"""WITH p AS (SELECT page_id, {HOST} AS host, url, CASE WHEN length({HOST}) % 2 = 0 THEN max(url) OVER (PARTITION BY {HOST}) ELSE 'none' END AS canonical FROM pages),
f AS (SELECT *, max(CASE WHEN url = canonical THEN 1 ELSE 0 END) OVER (PARTITION BY host) AS hit, min(url) OVER (PARTITION BY host) AS lo, max(url) OVER (PARTITION BY host) AS hi FROM p)
SELECT page_id FROM f WHERE CASE WHEN hit = 1 THEN url = canonical ELSE lo = hi END""")
def _(spark, d):
    p = table(spark, d, "pages").select("page_id", F.regexp_extract("url", "//([^/]*)", 1).alias("program_id"), F.col("url").alias("source_url"))
    s = p.groupBy("program_id").agg(F.max("source_url").alias("m")).select("program_id", F.when(F.length("program_id") % 2 == 0, F.col("m")).otherwise("none").alias("canonical_url"))
    return quality.roster_captures(p, s).select("page_id")


@query("cutoff_filter", "WITH f AS (SELECT user_id, min(ts) AS t FROM events WHERE event_type = 'purchase' AND user_id % 2 = 0 GROUP BY 1) SELECT event_id FROM events LEFT JOIN f USING (user_id) WHERE t IS NULL OR ts < t")
def _(spark, d):
    e = table(spark, d, "events")
    return quality.before_first_own(e, e.filter("event_type = 'purchase' and user_id % 2 = 0"), "user_id", "ts").select("event_id")


@query("range_limit", "SELECT event_id, ts FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' ORDER BY ts, event_id LIMIT 50")
def _(spark, d):
    return quality.capture_range(table(spark, d, "events").select("event_id", "ts"), "ts", "2024-01-05", "2024-01-20", 50, "event_id")


@query("fk_orphans", "SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c_custkey % 7 <> 0)")
def _(spark, d):
    return quality.orphans(table(spark, d, "orders"), table(spark, d, "customer").filter("c_custkey % 7 <> 0"), "o_custkey", "c_custkey").select("o_orderkey")


@query("childless_parents", "SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_orderstatus = 'P')")
def _(spark, d):
    return quality.childless(table(spark, d, "customer"), table(spark, d, "orders").filter("o_orderstatus = 'P'"), "c_custkey", "o_custkey").select("c_custkey")


@query("frame_reconcile", """WITH ours AS (SELECT c_nationkey AS nation, c_mktsegment AS kind FROM customer WHERE c_custkey % 5 = 0), theirs AS (SELECT DISTINCT s_nationkey AS nation, CASE WHEN s_suppkey % 2 = 0 THEN 'BUILDING' ELSE 'MACHINERY' END AS kind FROM supplier)
SELECT nation, kind, 'theirs_not_ours' AS direction, 'unresolved' AS classification FROM theirs WHERE NOT EXISTS (SELECT 1 FROM ours o WHERE o.nation = theirs.nation AND o.kind = theirs.kind)
UNION ALL SELECT nation, kind, 'ours_not_theirs', 'unresolved' FROM ours WHERE kind IN ('BUILDING', 'MACHINERY') AND NOT EXISTS (SELECT 1 FROM theirs o WHERE o.nation = ours.nation AND o.kind = ours.kind)""")
def _(spark, d):
    ours = table(spark, d, "customer").filter("c_custkey % 5 = 0").select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("kind"))
    theirs = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), F.when(F.col("s_suppkey") % 2 == 0, "BUILDING").otherwise("MACHINERY").alias("kind")).distinct()
    return reconcile.frame_reconcile(ours, theirs, ["nation", "kind"], "kind", theirs)


@query("split_inventory", "SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'unmapped' WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'implemented' ELSE 'informational' END AS label FROM part")
def _(spark, d):
    p = table(spark, d, "part").withColumn("kind", F.when(F.col("p_size") % 5 != 0, F.col("p_brand")))
    return reconcile.split_inventory(p, "kind", "p_type", ["ECONOMY", "PROMO"]).select("p_partkey", "label")


@query("fallback_union", "SELECT doc_id, 'label' AS origin FROM labels UNION ALL SELECT doc_id, 'document' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(spark, d):
    return reconcile.fallback_union(table(spark, d, "labels").select("doc_id", F.lit("label").alias("origin")), table(spark, d, "documents").select("doc_id", F.lit("document").alias("origin")), "doc_id")


CONFIG = "SELECT 'en' AS lang, 'the' AS query UNION ALL SELECT 'fr', 'tion' UNION ALL SELECT 'de', 'schü' UNION ALL SELECT 'en', 'LICENSE'"


@query("theta_match", f"WITH c AS ({CONFIG}) SELECT doc_id, documents.lang, query FROM documents JOIN c ON c.lang = documents.lang AND contains(lower(text), lower(query))")
def _(spark, d):
    return match.theta_match(table(spark, d, "documents"), spark.sql(CONFIG), "text", "lang").select("doc_id", "lang", "query")


MATCH_SQL = """a AS (SELECT p_partkey AS a, p_brand AS area, string_split(p_name, ' ') AS t FROM part WHERE p_partkey % 2 = 0), b AS (SELECT p_partkey AS b, p_brand AS area, string_split(p_name, ' ') AS t FROM part WHERE p_partkey % 2 = 1)"""


@query("entity_match", f"""WITH {MATCH_SQL}, m AS (SELECT a, b, len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t))) AS s FROM a JOIN b USING (area) WHERE list_has_any(a.t, b.t))
SELECT a, b, round(s, 6) AS similarity, CASE WHEN s >= 0.92 THEN 'accept' WHEN s >= 0.7 THEN 'review' ELSE 'reject' END AS band FROM m WHERE s >= 0.3""")
def _(spark, d):
    p = table(spark, d, "part").withColumn("name", normalize_name(F.col("p_name")))
    return match.entity_match(p.filter("p_partkey % 2 = 0").withColumnRenamed("p_partkey", "a"), p.filter("p_partkey % 2 = 1").withColumnRenamed("p_partkey", "b"), "a", "b", "name", "p_brand", 0.3).drop("p_brand")


@query("match_quality", """SELECT count(*) FILTER (WHERE p AND g) AS true_positive, count(*) FILTER (WHERE p AND NOT g) AS false_positive, count(*) FILTER (WHERE g AND NOT p) AS false_negative,
  round(count(*) FILTER (WHERE p AND g) / nullif(count(*) FILTER (WHERE p), 0), 6) AS precision, round(count(*) FILTER (WHERE p AND g) / nullif(count(*) FILTER (WHERE g), 0), 6) AS recall
FROM (SELECT doc_id, n_chars > 1000 AS p, quality = 1 AS g FROM labels JOIN documents USING (doc_id)) WHERE p OR g""")
def _(spark, d):
    both = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return match.match_quality(both.filter("n_chars > 1000"), both.filter("quality = 1"), ["doc_id"])


@query("rename_candidates", BASE + """, n AS (SELECT c_custkey AS provider_id, c_mktsegment || ' ' || CAST(c_custkey % 20 AS VARCHAR) AS name FROM customer)
SELECT g.program_id || '|' || CAST(g.seq AS VARCHAR) AS place, g.provider_id AS gone, c.provider_id AS come, CAST(1 AS DOUBLE) AS similarity FROM ev g JOIN n gn ON gn.provider_id = g.provider_id JOIN ev c ON c.program_id = g.program_id AND c.seq = g.seq
JOIN n cn ON cn.provider_id = c.provider_id WHERE g.event_type = 'disappeared_from_roster' AND c.event_type = 'authorized' AND gn.name = cn.name AND g.provider_id <> c.provider_id""")
def _(spark, d):
    names = table(spark, d, "customer").select(F.col("c_custkey").alias("provider_id"), F.concat_ws(" ", "c_mktsegment", (F.col("c_custkey") % 20).cast("string")).alias("name"))
    return match.rename_candidates(chain(spark, d), names, 0.9)


def _old_new(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey", (F.col("c_custkey") % 4 == 0).alias("verified"))
    old = c.filter("c_custkey % 3 <> 0").withColumn("c_acctbal", F.lit(0.0)).withColumn("c_nationkey", F.when(F.col("c_nationkey") % 2 == 0, F.col("c_nationkey")))
    return old, c.filter("c_custkey % 2 = 0").withColumn("verified", F.lit(False))


SIDES = """old AS (SELECT c_custkey, c_name, CAST(0 AS DOUBLE) AS c_acctbal, CASE WHEN c_nationkey % 2 = 0 THEN c_nationkey END AS c_nationkey, c_custkey % 4 = 0 AS verified FROM customer WHERE c_custkey % 3 <> 0),
new AS (SELECT c_custkey, c_name, c_acctbal, c_nationkey, false AS verified FROM customer WHERE c_custkey % 2 = 0)"""


@query("merge_upsert", f"WITH {SIDES} SELECT * FROM new UNION ALL SELECT * FROM old WHERE c_custkey NOT IN (SELECT c_custkey FROM new)")
def _(spark, d):
    return merge.merge_upsert(*_old_new(spark, d), ["c_custkey"])


@query("merge_immutable", f"WITH {SIDES} SELECT * FROM old UNION ALL SELECT * FROM new WHERE c_custkey NOT IN (SELECT c_custkey FROM old)")
def _(spark, d):
    return merge.merge_insert_new(*_old_new(spark, d), ["c_custkey"])


@query("merge_insert_new", f"WITH {SIDES} SELECT c_custkey, count(*) AS n FROM (SELECT c_custkey FROM old UNION ALL SELECT c_custkey FROM new WHERE c_custkey NOT IN (SELECT c_custkey FROM old)) GROUP BY 1")
def _(spark, d):
    return merge.merge_insert_new(*_old_new(spark, d), ["c_custkey"]).groupBy("c_custkey").agg(F.count("*").alias("n"))


@query("merge_first_seen", f"WITH {SIDES} SELECT c_custkey, coalesce(n.c_name, o.c_name) AS c_name, CASE WHEN o.c_custkey IS NOT NULL THEN o.c_acctbal ELSE n.c_acctbal END AS c_acctbal, coalesce(o.c_nationkey, n.c_nationkey) AS c_nationkey, coalesce(n.verified, o.verified) AS verified FROM old o FULL JOIN new n USING (c_custkey)")
def _(spark, d):
    return merge.merge_first_seen(*_old_new(spark, d), ["c_custkey"], keep=["c_nationkey"], frozen=["c_acctbal"])


@query("merge_verified", f"WITH {SIDES} SELECT c_custkey, CASE WHEN n.c_custkey IS NULL OR coalesce(o.verified, false) THEN o.c_acctbal ELSE n.c_acctbal END AS c_acctbal, CASE WHEN n.c_custkey IS NULL OR coalesce(o.verified, false) THEN o.verified ELSE n.verified END AS verified FROM old o FULL JOIN new n USING (c_custkey)")
def _(spark, d):
    return merge.merge_verified(*_old_new(spark, d), ["c_custkey"]).select("c_custkey", "c_acctbal", "verified")


@query("ledger_merge", "WITH l AS (SELECT n_name AS item, n_regionkey AS jurisdiction, true AS resolved FROM nation WHERE n_nationkey % 2 = 0), c AS (SELECT n_name AS item, n_regionkey + k AS jurisdiction, false AS resolved FROM nation, (SELECT unnest([0, 1, 0]) AS k)) SELECT * FROM l UNION ALL SELECT DISTINCT * FROM c WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.item = c.item AND l.jurisdiction = c.jurisdiction)")
def _(spark, d):
    n = table(spark, d, "nation").select(F.col("n_name").alias("item"), "n_regionkey", "n_nationkey")
    ledger = n.filter("n_nationkey % 2 = 0").select("item", F.col("n_regionkey").alias("jurisdiction"), F.lit(True).alias("resolved"))
    cand = n.select("item", F.posexplode(F.array(F.lit(0), F.lit(1), F.lit(0))).alias("ordinal", "k"), "n_regionkey").select("item", (F.col("n_regionkey") + F.col("k")).alias("jurisdiction"), F.lit(False).alias("resolved"), "ordinal")
    return merge.ledger_merge(ledger, cand, "ordinal")


@query("stamp_provenance", "SELECT o_orderkey, c_name AS source_url, CASE WHEN o_orderkey % 2 = 0 THEN 7 ELSE o_custkey END AS first_seen_snapshot_id, o_custkey AS last_seen_snapshot_id FROM orders JOIN customer ON o_custkey = c_custkey")
def _(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("k"), F.when(F.col("o_orderkey") % 2 == 0, F.lit(7)).cast("long").alias("first_seen_snapshot_id"))
    snaps = table(spark, d, "customer").select(F.col("c_custkey").alias("snapshot_id"), F.col("c_name").alias("source_url"))
    return merge.stamp_provenance(rows, snaps, "k", ["source_url"]).select("o_orderkey", "source_url", "first_seen_snapshot_id", "last_seen_snapshot_id")


@query("guarded_write", "SELECT o_orderkey, o_custkey % 7 <> 0 AS good FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)")
def _(spark, d):
    good, bad = merge.guarded_write(table(spark, d, "orders"), table(spark, d, "customer").filter("c_custkey % 7 <> 0"), "o_custkey", "c_custkey")
    return good.select("o_orderkey", F.lit(True).alias("good")).unionByName(bad.select("o_orderkey", F.lit(False).alias("good")))


@query("apply_signals", "SELECT c_custkey AS program_id, CASE WHEN c_custkey % 2 = 0 AND c_acctbal >= 5000 THEN 'sunset' ELSE 'active' END AS program_status FROM customer")
def _(spark, d):
    c = table(spark, d, "customer")
    programs = c.select(F.col("c_custkey").alias("program_id"), F.lit("active").alias("program_status"), F.lit(None).cast("date").alias("sunset_date"), F.col("c_name").alias("source_url"))
    signals_ = c.select(F.col("c_custkey").alias("program_id"), (F.col("c_custkey") % 2 == 0).alias("is_change"), (F.col("c_acctbal") / 10000).alias("confidence"), F.lit("sunset").alias("proposed_status"), F.lit(None).cast("date").alias("proposed_sunset"), F.lit("u").alias("source_url"))
    return merge.apply_signals(programs, signals_).select("program_id", "program_status")


@query("error_summary", """WITH e AS (SELECT o_orderpriority AS "check", CAST(o_orderkey AS VARCHAR) AS message FROM orders WHERE o_totalprice > 300000)
SELECT "check", count(*) AS n, array_to_string((list(message ORDER BY message))[1:10], ',') AS samples, count(*) - least(10, count(*)) AS more FROM e GROUP BY 1""")
def _(spark, d):
    o = table(spark, d, "orders").filter("o_totalprice > 300000")
    e = o.select(F.col("o_orderpriority").alias("check"), F.col("o_orderkey").cast("string").alias("key"), F.col("o_orderkey").cast("string").alias("message"))
    return quality.error_summary(e).withColumn("samples", F.array_join("samples", ","))


@query("undocumented_zero", "SELECT n_nationkey FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000) AND n_nationkey % 3 <> 0")
def _(spark, d):
    n = table(spark, d, "nation").select("n_nationkey")
    s = table(spark, d, "supplier").filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("n_nationkey"))
    return quality.undocumented_zero(n, s, n.filter("n_nationkey % 3 = 0"), "n_nationkey")


@query("floor_check", "WITH c AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) SELECT n_nationkey, 60 AS floor, coalesce(n, 0) AS n FROM nation LEFT JOIN c ON c_nationkey = n_nationkey WHERE coalesce(n, 0) < 60")
def _(spark, d):
    counts = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    return quality.floor_check(counts, table(spark, d, "nation").select("n_nationkey", F.lit(60).alias("floor")), "n_nationkey")


@query("set_coverage", "SELECT k, 'unknown' AS problem FROM ((SELECT c_custkey AS k FROM customer WHERE c_custkey % 2 = 0) EXCEPT (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)) UNION ALL SELECT k, 'undocumented' FROM ((SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 = 0) EXCEPT (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0))")
def _(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    return quality.set_coverage(c.filter("k % 2 = 0"), c.filter("k % 3 = 0"), "k")


@query("release_drift", "SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN -1 ELSE c_nationkey END AS c_nationkey, 'only_second' AS side FROM customer WHERE c_custkey % 10 = 0 UNION ALL SELECT c_custkey, c_nationkey, 'only_first' FROM customer WHERE c_custkey % 10 = 0")
def _(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return quality.release_drift(c, c.withColumn("c_nationkey", F.when(F.col("c_custkey") % 10 == 0, -1).otherwise(F.col("c_nationkey"))))


@query("blob_integrity", "SELECT CAST(doc_id AS VARCHAR) AS path, CASE WHEN doc_id % 5 = 0 THEN 'missing' ELSE 'hash_mismatch' END AS problem FROM documents WHERE doc_id % 5 = 0 OR (doc_id % 7 = 0 AND doc_id % 5 <> 0)")
def _(spark, d):
    t = table(spark, d, "documents").select("doc_id", F.col("doc_id").cast("string").alias("path"), F.sha2("text", 256).alias("sha256"))
    return quality.blob_integrity(t.withColumn("sha256", F.when(F.col("doc_id") % 7 == 0, "0").otherwise(F.col("sha256"))), t.filter("doc_id % 5 <> 0"))


@query("provenance_audit", """WITH snaps AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 50 <> 0 THEN c_name END AS u FROM customer WHERE c_custkey % 11 <> 0)
SELECT * FROM (SELECT 'provider_first_seen' AS "check", count(*) AS n FROM orders WHERE o_orderkey % 9 <> 0 AND o_custkey NOT IN (SELECT id FROM snaps)
UNION ALL SELECT 'provider_first_seen_null', count(*) FROM orders WHERE o_orderkey % 9 = 0
UNION ALL SELECT 'provider_last_seen', count(*) FROM orders WHERE o_custkey NOT IN (SELECT id FROM snaps)
UNION ALL SELECT 'event_snapshot', count(*) FROM events WHERE user_id NOT IN (SELECT id FROM snaps)
UNION ALL SELECT 'snapshot_url_null', count(*) FROM snaps WHERE u IS NULL
UNION ALL SELECT 'program_without_snapshot', count(*) FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_custkey % 11 <> 0 AND c_nationkey % 4 <> 0)
UNION ALL SELECT 'alias_provider', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) WHERE n > 0""")
def _(spark, d):
    return _audit(spark, d).groupBy("check").agg(F.count("*").alias("n"))


def _audit(spark, d):
    snaps = table(spark, d, "customer").filter("c_custkey % 11 <> 0").select(F.col("c_custkey").alias("snapshot_id"), F.when(F.col("c_nationkey") % 4 != 0, F.col("c_nationkey")).alias("program_id"), F.when(F.col("c_custkey") % 50 != 0, F.col("c_name")).alias("source_url"))
    orders = table(spark, d, "orders")
    providers = orders.select(F.col("o_orderkey").alias("provider_id"), F.when(F.col("o_orderkey") % 9 != 0, F.col("o_custkey")).alias("first_seen_snapshot_id"), F.col("o_custkey").alias("last_seen_snapshot_id"))
    events = table(spark, d, "events").select("event_id", F.col("user_id").alias("source_snapshot_id"))
    programs = table(spark, d, "nation").select(F.col("n_nationkey").alias("program_id"))
    aliases = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("provider_id"), F.col("l_linenumber").alias("alias_name"))
    return quality.provenance_audit(providers, events, snaps, programs, aliases)

"""Queries on whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality
from ..sources import nested
from ..sources.tables import roster_observations, snapshots, table
from . import jobs
from .diffs import BASE, chain
from .registry import query


@query("rebuild_job", BASE + "SELECT program_id, provider_id, seq, event_type, new_status, event_id FROM ev")
def _(spark, d):
    obs = roster_observations(spark, d)
    snaps = snapshots(obs).select("program_id", "snapshot_id", F.lit("u").alias("source_url"), F.col("snap_date").alias("retrieved_at"), F.col("snapshot_id").alias("content_sha256"))
    rows = obs.select("program_id", F.col("snap_date").alias("retrieved_at"), "provider_id", F.lit(1).alias("row_no"), "status")
    sources = snaps.select("program_id", F.col("source_url").alias("canonical_url")).distinct()
    return jobs.rebuild(snaps, rows, sources, sources.select("program_id")).events.select("program_id", "provider_id", "seq", "event_type", "new_status", "event_id")


SAME = "length(program_id) % 2 = 0"


@query("incremental_job", BASE + f""", n AS (SELECT program_id, count(DISTINCT provider_id) AS providers FROM seen WHERE seq = 2 GROUP BY 1)
SELECT program_id, CASE WHEN {SAME} THEN 'unchanged' ELSE 'updated' END AS run_status, providers,
  count(*) FILTER (WHERE event_type = 'authorized' AND NOT ({SAME})) AS added, count(*) FILTER (WHERE event_type = 'disappeared_from_roster' AND NOT ({SAME})) AS removed,
  count(*) FILTER (WHERE event_type = 'status_change' AND NOT ({SAME})) AS changed FROM n LEFT JOIN (SELECT * FROM ev WHERE seq = 2) e USING (program_id) GROUP BY ALL""")
def _(spark, d):
    obs = roster_observations(spark, d)
    seen = obs.join(snapshots(obs), ["program_id", "snap_date"])
    bytes_of = lambda seq: seen.filter(F.col("seq") == seq).select("program_id", F.when(F.expr(SAME), "same").otherwise(F.lit(str(seq))).alias("content_sha256")).distinct()
    return jobs.incremental(seen.filter("seq = 1"), seen.filter("seq = 2"), bytes_of(1), bytes_of(2))[1]


@query("run_summary", BASE + """, n AS (SELECT program_id, count(DISTINCT provider_id) AS providers FROM obs GROUP BY 1)
SELECT program_id, providers, count(*) FILTER (WHERE event_type = 'authorized') AS added, count(*) FILTER (WHERE event_type = 'disappeared_from_roster') AS removed, count(*) FILTER (WHERE event_type = 'status_change') AS changed
FROM n JOIN ev USING (program_id) GROUP BY ALL""")
def _(spark, d):
    return jobs.run_summary(roster_observations(spark, d), chain(spark, d))


@query("backfill_report", """WITH b AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
c AS (SELECT user_id, value, CASE WHEN p = event_type THEN 'skipped' WHEN value < 5 THEN 'parse_error' WHEN value < 10 THEN 'empty' ELSE 'ingested' END AS k FROM b)
SELECT user_id, count(*) FILTER (WHERE k = 'ingested') AS ingested, count(*) FILTER (WHERE k = 'skipped') AS skipped, count(*) FILTER (WHERE k = 'parse_error') AS parse_error,
  count(*) FILTER (WHERE k = 'empty') AS empty, count(*) FILTER (WHERE k = 'ingested' AND value > 150) AS partial FROM c GROUP BY 1""")
def _(spark, d):
    e = table(spark, d, "events")
    captures = e.select(
        F.col("user_id").alias("program_id"), F.col("event_id").alias("capture_id"), F.col("ts").alias("captured_at"), F.col("event_type").alias("digest"),
        F.when(F.col("value") < 5, "unreadable").alias("error"), (F.col("value") > 150).alias("is_partial"),
    )
    parsed = e.filter("value >= 10").select(F.col("user_id").alias("program_id"), F.col("event_id").alias("capture_id"), F.lit(1).alias("provider_id"), F.lit("active").alias("status"))
    own = captures.limit(0).select("program_id", "captured_at", F.col("capture_id").alias("snapshot_id"))
    return jobs.backfill(captures, own, parsed)[3].withColumnRenamed("program_id", "user_id")


@query("bundle_counts", """SELECT n_nationkey AS program_id, n_regionkey AS jurisdiction, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS providers,
(SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal > 0) AS active, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) > 0 AS has_providers FROM nation""")
def _(spark, d):
    return _bundle(spark, d).programs


@query("bundle_places", """WITH c AS (SELECT n_nationkey, n_regionkey, count(c_custkey) AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL)
SELECT n_regionkey AS jurisdiction, string_agg(CAST(n_nationkey AS VARCHAR), ',' ORDER BY n_nationkey) AS program_ids, CAST(sum(n) AS BIGINT) AS providers, bool_and(n = 0) AS all_zero FROM c GROUP BY 1""")
def _(spark, d):
    return _bundle(spark, d).places.withColumn("program_ids", F.array_join(F.transform("program_ids", lambda x: x.cast("string")), ","))


def _bundle(spark, d):
    programs = table(spark, d, "nation").select(F.col("n_nationkey").alias("program_id"), F.col("n_regionkey").alias("jurisdiction"))
    providers = table(spark, d, "customer").select(F.col("c_nationkey").alias("program_id"), F.col("c_custkey").alias("provider_id"), F.when(F.col("c_acctbal") > 0, "active").otherwise("exited").alias("current_status"))
    events = table(spark, d, "orders").select(F.col("o_custkey").alias("program_id"), F.col("o_orderdate").alias("event_date"), F.lit("authorized").alias("event_type"))
    return jobs.bundle(programs, providers, events, programs.limit(0))


INVENTORY = """SELECT s_nationkey AS jurisdiction, CASE s_suppkey % 4 WHEN 1 THEN 'MACHINERY' WHEN 2 THEN NULL ELSE 'BUILDING' END AS model_type,
CASE WHEN s_suppkey % 3 = 0 THEN 'Proposed' ELSE 'Implemented' END AS status_bucket FROM supplier"""
KNOWN = "SELECT 'theirs_not_ours BUILDING' AS item, n_nationkey AS jurisdiction, 'documented' AS classification, true AS resolved, 'person' AS detected_by FROM nation WHERE n_regionkey < 2"


@query("completeness_job", f"""WITH ours AS (SELECT DISTINCT c_nationkey AS jurisdiction, c_mktsegment AS model_type FROM customer WHERE c_acctbal > 9000),
theirs AS (SELECT DISTINCT jurisdiction, model_type FROM ({INVENTORY}) WHERE model_type IS NOT NULL AND status_bucket = 'Implemented'),
gaps AS (SELECT 'theirs_not_ours ' || model_type AS item, jurisdiction FROM (SELECT * FROM theirs EXCEPT SELECT * FROM ours)
  UNION ALL SELECT 'ours_not_theirs ' || model_type, jurisdiction FROM (SELECT * FROM ours EXCEPT SELECT * FROM theirs) WHERE model_type IN (SELECT model_type FROM theirs)),
ledger AS ({KNOWN})
SELECT * FROM ledger UNION ALL SELECT item, jurisdiction, 'unresolved', false, 'frame_reconcile' FROM gaps WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.item = gaps.item AND l.jurisdiction = gaps.jurisdiction)""")
def _(spark, d):
    ours = table(spark, d, "customer").filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("jurisdiction"), F.col("c_mktsegment").alias("model_type"))
    return jobs.completeness(ours, spark.sql(INVENTORY.replace("FROM supplier", "FROM {supplier}"), supplier=table(spark, d, "supplier")), spark.sql(KNOWN.replace("FROM nation", "FROM {nation}"), nation=table(spark, d, "nation")), ("Implemented",))[0]


BILL_TITLE = "CASE p_partkey % 5 WHEN 0 THEN 'An act to establish a pilot' WHEN 1 THEN 'Repeal of the program' WHEN 2 THEN 'Establish or repeal' WHEN 3 THEN 'Budget of the pilot program' ELSE 'Roads' END"
BILL_ACTION = "CASE p_partkey % 3 WHEN 0 THEN 'Signed by Governor' WHEN 1 THEN 'Died in committee' ELSE 'Introduced' END"


STATUS_SQL = f"""WITH b AS (SELECT p_partkey AS id, p_brand AS program_id, lower({BILL_TITLE}) AS t, p_partkey % 3 = 0 AS enacted, p_partkey % 3 = 1 AS failed,
  EXISTS (SELECT 1 FROM part k WHERE k.p_brand = b.p_brand AND k.p_partkey % 50 = 0 AND contains('hb' || b.p_partkey, 'hb' || k.p_partkey)) AS known FROM part b),
s AS (SELECT *, CASE WHEN t LIKE '%establish%' AND t LIKE '%repeal%' THEN 'neutral' WHEN t LIKE '%repeal%' THEN 'negative' WHEN t LIKE '%establish%' OR t LIKE '%pilot%' THEN 'positive' ELSE 'unknown' END AS way,
  least(1e0, CASE WHEN known THEN 5e-1 ELSE 0e0 END + (CASE WHEN t LIKE '%pilot%' THEN 1 ELSE 0 END + CASE WHEN t LIKE '%program%' THEN 1 ELSE 0 END) * 15e-2 + CASE WHEN enacted THEN 2e-1 ELSE 0e0 END) AS score
  FROM b WHERE t LIKE '%pilot%' OR t LIKE '%program%' OR known),
r AS (SELECT *, row_number() OVER (PARTITION BY program_id ORDER BY round(score, 6) DESC, id) AS k FROM s),
top AS (SELECT * FROM r WHERE k = 1), e AS (SELECT program_id, string_agg(CAST(id AS VARCHAR), ',' ORDER BY k) AS evidence FROM r WHERE k <= 5 GROUP BY 1),
o AS (SELECT program_id, program_id LIKE '%5' AS given, e.evidence, top.*  EXCLUDE (program_id) FROM (SELECT DISTINCT p_brand AS program_id FROM part) LEFT JOIN top USING (program_id) LEFT JOIN e USING (program_id)),
p AS (SELECT *, CASE WHEN given THEN 'sunset' WHEN score < 0.3 THEN NULL WHEN way = 'negative' AND enacted THEN 'sunset' WHEN way = 'positive' AND enacted THEN 'active' WHEN way = 'positive' AND NOT failed THEN 'proposed' END AS proposed FROM o)"""


@query("resolve_status_job", f"""{STATUS_SQL}
SELECT program_id, proposed AS proposed_status, CASE WHEN given THEN DATE '2021-07-31' END AS proposed_sunset,
  round(CASE WHEN given THEN 1e0 WHEN score >= 0.3 AND way = 'negative' AND NOT enacted THEN score * 4e-1 ELSE coalesce(score, 0e0) END, 6) AS confidence, evidence,
  CASE WHEN given THEN 'rule' ELSE 'bill/' || id END AS source_url, given OR coalesce(proposed <> 'active', false) AS is_change FROM p""")
def _(spark, d):
    out = _signals(spark, d)
    return out.select("program_id", "proposed_status", "proposed_sunset", F.round("confidence", 6).alias("confidence"), F.array_join(F.transform("evidence", lambda x: x.cast("string")), ",").alias("evidence"), "source_url", "is_change")


def _signals(spark, d):
    part = table(spark, d, "part")
    bills = part.select(
        F.col("p_partkey").alias("bill_id"), F.concat(F.lit("HB "), "p_partkey").alias("identifier"), F.expr(BILL_TITLE).alias("title"), F.lit(None).cast("string").alias("abstract"), F.col("p_brand").alias("state"),
        F.expr(BILL_ACTION).alias("latest_action"), F.lit(None).cast("date").alias("action_date"), F.array().cast("array<string>").alias("classes"), F.concat(F.lit("bill/"), "p_partkey").alias("url"),
    )
    given = F.col("p_brand").like("%5")
    configs = part.groupBy("p_brand").agg(F.collect_list(F.when(F.col("p_partkey") % 50 == 0, F.concat(F.lit("HB"), "p_partkey"))).alias("known_bills")).select(
        F.col("p_brand").alias("program_id"), F.col("p_brand").alias("state"), F.array(F.lit("pilot"), F.lit("program")).alias("queries"), "known_bills", F.lit(False).alias("pending_rules"),
        F.when(given, "sunset").alias("override"), F.when(given, F.to_date(F.lit("2021-07-31"))).alias("override_sunset"), F.when(given, "rule").alias("override_url"),
    )
    programs = configs.select("program_id", F.lit("active").alias("program_status"))
    return jobs.resolve_status(programs, bills, configs)


@query("status_reasons", f"""{STATUS_SQL}
SELECT program_id, CASE WHEN given THEN 'set by an order, not by a bill: rule' WHEN score IS NULL THEN 'no bill found'
  ELSE CASE WHEN score < 0.3 THEN 'best bill of little relevance' WHEN way = 'negative' AND enacted THEN 'ending bill enacted' WHEN way = 'positive' AND enacted THEN 'founding bill enacted'
  WHEN way = 'positive' AND NOT failed THEN 'founding bill pending' WHEN way = 'negative' THEN 'ending bill pending' ELSE 'direction unclear' END || ': HB ' || id END AS reason FROM p""")
def _(spark, d):
    return _signals(spark, d).select("program_id", "reason")


@query("bills_exploded", """SELECT CAST(o_orderkey AS VARCHAR) AS bill_id, o_clerk AS identifier, 'UT' AS state, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END AS latest_action,
CAST(o_orderdate AS DATE) AS action_date, 'a|b|' || o_orderstatus AS classes, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS abstract FROM (SELECT *, o_orderpriority AS o_clerk FROM orders)""")
def _(spark, d):
    key = F.col("o_orderkey")
    bill = F.struct(
        key.cast("string").alias("id"), F.col("o_orderpriority").alias("identifier"), F.lit("t").alias("title"), F.lit("s").alias("session"), F.struct(F.lit("ocd/state:ut/government").alias("id")).alias("jurisdiction"),
        F.when(key % 3 != 0, F.col("o_orderstatus")).alias("latest_action_description"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("latest_action_date"),
        F.array(F.struct(F.array(F.lit("a"), F.lit("b")).alias("classification")), F.struct(F.array("o_orderstatus").alias("classification"))).alias("actions"),
        F.when(key % 2 == 0, F.array(F.struct(F.col("o_orderpriority").alias("abstract")))).otherwise(F.array().cast("array<struct<abstract:string>>")).alias("abstracts"),
    )
    pages_ = table(spark, d, "orders").select(F.to_json(F.struct(F.array(bill).alias("results"))).alias("page"))
    out = nested.explode_bills(pages_, "page")
    return out.select("bill_id", "identifier", "state", "latest_action", "action_date", F.array_join("classes", "|").alias("classes"), "abstract")


@query("distinct_urls", "SELECT DISTINCT o_custkey AS program_id, o_orderpriority AS source_url FROM orders")
def _(spark, d):
    return quality.distinct_urls(table(spark, d, "orders").select(F.col("o_custkey").alias("program_id"), F.col("o_orderpriority").alias("source_url")))

"""Queries on revised histories, counts over time by change points, gaps by bitmaps, release fingerprints, one-to-one matches."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions.names import normalize_name
from ..operators import diff, match, quality, revise, status
from ..sources.tables import roster_observations, snapshots, table
from .checks import MATCH_SQL
from .diffs import BASE, CHAIN, SNAPS, log
from .registry import query

EVENT_SQL = "program_id, provider_id, event_type, new_status, detail, snapshot_id, snap_date, event_id"
#: The same chain of two thirds of the days: every third day arrives late.
IN_TIME = "day(snap_date) % 3 <> 0"
KEPT = f"obs_k AS (SELECT * FROM obs WHERE {IN_TIME}), " + re.sub(r"\b(obs|snaps|seen|pairs|ev)\b", r"\1_k", f"{SNAPS}, {CHAIN}")


def _revised(spark, d):
    """(the log of the captures in time, its revision by those that come late)."""
    obs = roster_observations(spark, d)
    late = obs.filter(f"not ({IN_TIME})")
    kept = obs.filter(IN_TIME)
    snaps = snapshots(kept)
    log = diff.with_event_id(diff.diff_chain(kept, snaps))
    return log, revise.revise(log, kept, snaps, late, snapshots(late))


@query("late_captures", BASE + f""", {KEPT} SELECT 'insert' AS op, * FROM (SELECT {EVENT_SQL} FROM ev EXCEPT SELECT {EVENT_SQL} FROM ev_k)
UNION ALL SELECT 'retract', * FROM (SELECT {EVENT_SQL} FROM ev_k EXCEPT SELECT {EVENT_SQL} FROM ev)""")
def _(spark, d):
    _, r = _revised(spark, d)
    return r.insertions.withColumn("op", F.lit("insert")).unionByName(r.retractions.withColumn("op", F.lit("retract")))


@query("late_captures_applied", BASE + f"SELECT {EVENT_SQL} FROM ev")
def _(spark, d):
    before, r = _revised(spark, d)
    return revise.apply_revision(before.drop("seq"), r)


@query("late_captures_order", BASE + f"SELECT program_id, snap_date, snapshot_id, seq FROM snaps")
def _(spark, d):
    return _revised(spark, d)[1].snapshots


@query("late_captures_status", BASE + "SELECT program_id, provider_id, max_by(new_status, (snap_date, event_id)) AS current_status FROM ev GROUP BY ALL")
def _(spark, d):
    before, r = _revised(spark, d)
    dated = lambda df: df.withColumnRenamed("snap_date", "event_date")
    keys = ["program_id", "provider_id"]
    entities = status.recompute_status(before.select(*keys).distinct().withColumn("current_status", F.lit("unknown")), dated(before), keys)
    after = dated(revise.apply_revision(before.drop("seq"), r))
    known = after.select(*keys).distinct().join(entities, keys, "left").withColumn("current_status", F.coalesce("current_status", F.lit("unknown")))
    return revise.revised_status(known, after, r)


@query("status_asof_daily", BASE + """, dates AS (SELECT unnest(range(DATE '2023-12-20', DATE '2024-03-01', INTERVAL 6 HOUR)) AS as_of),
s AS (SELECT as_of, program_id, provider_id, max_by(new_status, (snap_date, event_id)) AS status FROM ev JOIN dates ON snap_date <= as_of GROUP BY ALL)
SELECT as_of, program_id, status, count(*) AS n FROM s GROUP BY ALL""")
def _(spark, d):
    dates = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ '2023-12-20 00:00:00', TIMESTAMP_NTZ '2024-02-29 18:00:00', INTERVAL 6 HOUR)) AS as_of")
    return status.status_asof(log(spark, d).withColumn("event_date", F.col("event_date").cast("timestamp_ntz")), dates)


@query("sequence_gaps_sparse", "SELECT b + 1 AS gap_start, id - 1 AS gap_end FROM (SELECT id, lag(id) OVER (ORDER BY id) AS b FROM (SELECT DISTINCT (o_orderkey - 700) * (o_orderkey % 7 + 1) * 1009 AS id FROM orders)) WHERE id - b > 1")
def _(spark, d):
    return status.sequence_gaps(table(spark, d, "orders").select(((F.col("o_orderkey") - 700) * (F.col("o_orderkey") % 7 + 1) * 1009).alias("id")), "id")


DRIFT = "o_orderkey % 500 = 3"


@query("release_drift_rows", f"""WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 900 = 1),
b AS (SELECT o_orderkey, o_custkey, CASE WHEN {DRIFT} THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 700 <> 2)
SELECT 'only_first' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'only_second', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    b = o.filter("o_orderkey % 700 <> 2").withColumn("o_orderstatus", F.expr(f"CASE WHEN {DRIFT} THEN NULL ELSE o_orderstatus END"))
    return quality.release_drift(o.unionByName(o.filter("o_orderkey % 900 = 1")), b, ["o_orderkey"])


GREEDY = """m AS (
  SELECT DISTINCT area, 0 AS step, CAST([] AS BIGINT[]) AS used_a, CAST([] AS BIGINT[]) AS used_b, CAST(NULL AS STRUCT(s DOUBLE, a BIGINT, b BIGINT)) AS x FROM pairs_in
  UNION ALL
  SELECT area, step + 1, list_append(used_a, x.a), list_append(used_b, x.b), x FROM (
    SELECT m.area, m.step, m.used_a, m.used_b, min({'s': -p.similarity, 'a': p.a, 'b': p.b}) AS x FROM m JOIN pairs_in p ON p.area = m.area
    WHERE NOT list_contains(m.used_a, p.a) AND NOT list_contains(m.used_b, p.b) GROUP BY m.area, m.step, m.used_a, m.used_b))"""


@query("renames", BASE.replace("WITH ", "WITH RECURSIVE ", 1) + f""", n AS (SELECT c_custkey AS provider_id, c_mktsegment || ' ' || CAST(c_custkey % 20 AS VARCHAR) AS name FROM customer),
pairs_in AS (SELECT g.program_id || '|' || CAST(g.seq AS VARCHAR) AS area, g.provider_id AS a, c.provider_id AS b, CAST(1 AS DOUBLE) AS similarity FROM ev g JOIN n gn ON gn.provider_id = g.provider_id
  JOIN ev c ON c.program_id = g.program_id AND c.seq = g.seq JOIN n cn ON cn.provider_id = c.provider_id
  WHERE g.event_type = 'disappeared_from_roster' AND c.event_type = 'authorized' AND gn.name = cn.name AND g.provider_id <> c.provider_id), {GREEDY}
SELECT area AS place, x.a AS gone, x.b AS come, -x.s AS similarity FROM m WHERE step > 0""")
def _(spark, d):
    names = table(spark, d, "customer").select(F.col("c_custkey").alias("provider_id"), F.concat_ws(" ", "c_mktsegment", (F.col("c_custkey") % 20).cast("string")).alias("name"))
    return match.renames(log(spark, d), names, 0.9)


@query("entity_match_one_to_one", f"""WITH RECURSIVE {MATCH_SQL}, pairs_in AS (
  SELECT a.area, a, b, round(len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t))), 6) AS similarity FROM a JOIN b USING (area)
  WHERE len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t))) >= 0.5), {GREEDY}
SELECT area AS p_brand, x.a AS a, x.b AS b, -x.s AS similarity FROM m WHERE step > 0""")
def _(spark, d):
    p = table(spark, d, "part").withColumn("name", normalize_name(F.col("p_name")))
    return match.entity_match_one_to_one(p.filter("p_partkey % 2 = 0").withColumnRenamed("p_partkey", "a"), p.filter("p_partkey % 2 = 1").withColumnRenamed("p_partkey", "b"), "a", "b", "name", "p_brand", 0.5)

"""Queries on rosters, events and status over time."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import counts, diff, status
from ..sources.tables import monthly_observations, roster_observations, snapshots, table
from .registry import query

OBS = """obs AS (
  SELECT event_type AS program_id, CAST(ts AS DATE) AS snap_date, user_id AS provider_id,
         CASE WHEN max_by(value, (ts, event_id)) < 50 THEN 'suspended' WHEN max_by(value, (ts, event_id)) < 150 THEN 'active' ELSE 'exited' END AS status
  FROM events GROUP BY ALL)"""
MONTHS = """obs AS (
  SELECT 'orders' AS program_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS snap_date, o_custkey AS provider_id,
         max_by(o_orderstatus, (o_orderdate, o_orderkey)) AS status
  FROM orders GROUP BY ALL)"""
SNAPS = """snaps AS (
  SELECT program_id, snap_date, 'snap_' || substr(sha256(program_id || '|' || CAST(snap_date AS VARCHAR)), 1, 16) AS snapshot_id,
         row_number() OVER (PARTITION BY program_id ORDER BY snap_date) AS seq
  FROM (SELECT DISTINCT program_id, snap_date FROM obs))"""
CHAIN = """seen AS (SELECT o.*, s.seq FROM obs o JOIN snaps s USING (program_id, snap_date)),
pairs AS (
  SELECT n.program_id, n.provider_id, n.seq, NULL AS old, n.status AS new FROM seen n LEFT JOIN seen o
    ON o.program_id = n.program_id AND o.provider_id = n.provider_id AND o.seq = n.seq - 1 WHERE o.seq IS NULL
  UNION ALL
  SELECT o.program_id, o.provider_id, o.seq + 1, o.status, NULL FROM seen o JOIN snaps s ON s.program_id = o.program_id AND s.seq = o.seq + 1
    LEFT JOIN seen n ON o.program_id = n.program_id AND o.provider_id = n.provider_id AND n.seq = o.seq + 1 WHERE n.seq IS NULL
  UNION ALL
  SELECT n.program_id, n.provider_id, n.seq, o.status, n.status FROM seen n JOIN seen o
    ON o.program_id = n.program_id AND o.provider_id = n.provider_id AND o.seq = n.seq - 1 WHERE o.status <> n.status),
ev AS (
  SELECT p.program_id, p.provider_id, p.seq,
         CASE WHEN old IS NULL THEN 'authorized' WHEN new IS NULL THEN 'disappeared_from_roster' ELSE 'status_change' END AS event_type,
         CASE WHEN new IS NULL THEN 'exited' ELSE new END AS new_status,
         CASE WHEN old IS NOT NULL AND new IS NOT NULL THEN old || ' → ' || new END AS detail, s.snap_date, s.snapshot_id,
         'evt_' || substr(sha256(CAST(p.provider_id AS VARCHAR) || ':' || s.snapshot_id || ':' ||
           CASE WHEN old IS NULL THEN 'authorized' WHEN new IS NULL THEN 'disappeared_from_roster' ELSE 'status_change' END), 1, 24) AS event_id
  FROM pairs p JOIN snaps s ON s.program_id = p.program_id AND s.seq = p.seq)"""
BASE = f"WITH {OBS}, {SNAPS}, {CHAIN} "


def chain(spark, d):
    obs = roster_observations(spark, d)
    return diff.with_event_id(diff.diff_chain(obs, snapshots(obs)))


def log(spark, d):
    """Events with the names that the status operators use."""
    return chain(spark, d).withColumnRenamed("snap_date", "event_date")


EVENT_COLUMNS = ("program_id", "provider_id", "seq", "event_type", "new_status", "detail", "event_id")
EVENT_SQL = "program_id, provider_id, seq, event_type, new_status, detail, event_id"


@query("diff_chain", BASE + f"SELECT {EVENT_SQL} FROM ev")
def _(spark, d):
    return chain(spark, d).select(*EVENT_COLUMNS)


@query("diff_chain_monthly", f"WITH {MONTHS}, {SNAPS}, {CHAIN} SELECT program_id, provider_id, seq, event_type, new_status, detail FROM ev")
def _(spark, d):
    obs = monthly_observations(spark, d)
    return diff.diff_chain(obs, snapshots(obs)).select(*EVENT_COLUMNS[:-1])


@query("snapshot_diff", BASE + "SELECT program_id, provider_id, event_type, new_status, detail FROM ev WHERE seq = 2")
def _(spark, d):
    obs = roster_observations(spark, d)
    seen = obs.join(snapshots(obs), ["program_id", "snap_date"])
    return diff.snapshot_diff(seen.filter("seq = 1"), seen.filter("seq = 2"))


LAST = "last AS (SELECT provider_id, program_id, max_by(new_status, (snap_date, event_id)) AS st FROM ev GROUP BY ALL)"


def _by_both(df):
    return df.withColumn("key", F.concat_ws(":", "program_id", F.col("provider_id").cast("string")))


def _current(spark, d):
    events = _by_both(log(spark, d))
    entities = events.select("key", "program_id", "provider_id").distinct().withColumn("current_status", F.lit("unknown"))
    return status.recompute_status(entities, events, "key")


@query("recompute_status", BASE + f", {LAST} SELECT program_id, provider_id, st AS current_status FROM last")
def _(spark, d):
    return _current(spark, d).select("program_id", "provider_id", "current_status")


@query("active_by_program", BASE + f", {LAST} SELECT program_id, count(*) AS providers, count(*) FILTER (WHERE st = 'active') AS active FROM last GROUP BY program_id")
def _(spark, d):
    return counts.counts_by_value(_current(spark, d), ["program_id"], "current_status", {"active": "active"}, "providers")


@query("consecutive_dedup", "SELECT event_id FROM (SELECT event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events) WHERE b IS NULL OR b <> event_type")
def _(spark, d):
    return diff.consecutive_dedup(table(spark, d, "events"), "user_id", ["ts", "event_id"], "event_type").select("event_id")


@query("last_wins", "SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id")
def _(spark, d):
    return diff.last_in_roster(table(spark, d, "events"), ("user_id",), "event_id").select("user_id", "event_id")


SPELLS = "runs AS (SELECT program_id, provider_id, snap_date, seq - row_number() OVER (PARTITION BY program_id, provider_id ORDER BY seq) AS r FROM obs JOIN snaps USING (program_id, snap_date))"


@query("provider_spells", f"WITH {OBS}, {SNAPS}, {SPELLS} SELECT program_id, provider_id, min(snap_date) AS start_date, max(snap_date) AS end_date, count(*) AS n_snapshots, date_diff('day', min(snap_date), max(snap_date)) AS days FROM runs GROUP BY program_id, provider_id, r")
def _(spark, d):
    obs = roster_observations(spark, d)
    return diff.provider_spells(obs, snapshots(obs))


GRACE = """w AS (SELECT *, lead(event_type) OVER x AS nk, lead(seq) OVER x AS ns, lag(event_type) OVER x AS lk, lag(seq) OVER x AS ls FROM ev
  WINDOW x AS (PARTITION BY program_id, provider_id ORDER BY seq, CASE WHEN event_type = 'disappeared_from_roster' THEN 1 ELSE 0 END))"""


@query("grace_window", BASE + f""", {GRACE} SELECT program_id, provider_id, seq, event_type FROM w
WHERE NOT (coalesce(event_type = 'disappeared_from_roster' AND nk = 'authorized' AND ns - seq <= 2, false) OR coalesce(event_type = 'authorized' AND lk = 'disappeared_from_roster' AND seq - ls <= 2, false))""")
def _(spark, d):
    return diff.grace_window(chain(spark, d), 2).select("program_id", "provider_id", "seq", "event_type")


@query("backfill_authorized", f"""WITH {OBS}, {SNAPS} SELECT 'evt_' || substr(sha256(CAST(provider_id AS VARCHAR) || ':' || snapshot_id || ':authorized'), 1, 24) AS event_id, provider_id, snap_date AS event_date,
  'authorized' AS event_type, status AS new_status, snapshot_id FROM obs JOIN snaps USING (program_id, snap_date) QUALIFY row_number() OVER (PARTITION BY program_id, provider_id ORDER BY snap_date) = 1""")
def _(spark, d):
    obs = roster_observations(spark, d)
    snaps = snapshots(obs)
    first = status.first_per_key(obs.join(snaps, ["program_id", "snap_date"]), ["program_id", "provider_id"], ["snap_date"])
    providers = first.select("provider_id", F.col("snapshot_id").alias("first_seen_snapshot_id"), F.col("status").alias("current_status"))
    return diff.backfill_authorized(providers, snaps).drop("detail")


@query("net_roster", BASE + """, s AS (SELECT program_id, snap_date AS event_date, sum(CASE event_type WHEN 'authorized' THEN 1 WHEN 'disappeared_from_roster' THEN -1 ELSE 0 END) AS change FROM ev GROUP BY ALL)
SELECT program_id, event_date, change, sum(change) OVER (PARTITION BY program_id ORDER BY event_date) AS size FROM s""")
def _(spark, d):
    return status.net_roster(log(spark, d))


@query("status_asof", BASE + """, dates AS (SELECT unnest([DATE '2024-01-05', DATE '2024-01-15', DATE '2024-01-25']) AS as_of),
s AS (SELECT as_of, program_id, provider_id, max_by(new_status, (snap_date, event_id)) AS status FROM ev JOIN dates ON snap_date <= as_of GROUP BY ALL)
SELECT as_of, program_id, status, count(*) AS n FROM s GROUP BY ALL""")
def _(spark, d):
    dates = spark.sql("SELECT explode(array(DATE '2024-01-05', DATE '2024-01-15', DATE '2024-01-25')) AS as_of")
    return status.status_asof(log(spark, d), dates)


@query("capture_gaps", "SELECT user_id, gap_from, gap_to, date_diff('day', CAST(gap_from AS DATE), CAST(gap_to AS DATE)) AS gap_days FROM (SELECT user_id, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS gap_from, ts AS gap_to FROM events) WHERE date_diff('day', CAST(gap_from AS DATE), CAST(gap_to AS DATE)) > 1")
def _(spark, d):
    return status.capture_gaps(table(spark, d, "events"), "user_id", "ts", 1)


@query("bridge_gap", """SELECT user_id, gap_from, gap_to, date_diff('day', CAST(gap_from AS DATE), CAST(gap_to AS DATE)) AS gap_days FROM
(SELECT user_id, max(ts) AS gap_from FROM events WHERE ts < TIMESTAMP '2024-01-10' GROUP BY 1) JOIN (SELECT user_id, min(ts) AS gap_to FROM events WHERE ts >= TIMESTAMP '2024-01-12' GROUP BY 1) USING (user_id)
WHERE date_diff('day', CAST(gap_from AS DATE), CAST(gap_to AS DATE)) > 2""")
def _(spark, d):
    e = table(spark, d, "events")
    return status.bridge_gap(e.filter("ts < '2024-01-10'"), e.filter("ts >= '2024-01-12'"), "user_id", "ts", 2)


@query("event_history", BASE + """SELECT program_id || ':' || CAST(provider_id AS VARCHAR) AS key, string_agg(event_type || '@' || CAST(seq AS VARCHAR), ',' ORDER BY seq, event_type) AS history FROM ev GROUP BY 1""")
def _(spark, d):
    h = status.event_history(_by_both(chain(spark, d)), "key", "seq", "event_type")
    return h.select("key", F.array_join(F.transform("history", lambda e: F.concat_ws("@", e.event_type, e.seq.cast("string"))), ",").alias("history"))


@query("latest_per_key", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def _(spark, d):
    return status.latest_per_key(table(spark, d, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("first_per_key", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1")
def _(spark, d):
    return status.first_per_key(table(spark, d, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("sequence_gaps", "SELECT b + 1 AS gap_start, id - 1 AS gap_end FROM (SELECT id, lag(id) OVER (ORDER BY id) AS b FROM (SELECT DISTINCT l_orderkey AS id FROM lineitem)) WHERE id - b > 1")
def _(spark, d):
    return status.sequence_gaps(table(spark, d, "lineitem"), "l_orderkey")


@query("stratified_sample", """SELECT c_custkey FROM customer QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY sha256(CAST(c_custkey AS VARCHAR) || '|0'), c_custkey) <= greatest(15, ceil(count(*) OVER (PARTITION BY c_mktsegment) * 0.1))""")
def _(spark, d):
    return status.stratified_sample(table(spark, d, "customer"), ["c_mktsegment"], "c_custkey").select("c_custkey")


@query("event_type_counts", BASE + "SELECT program_id, event_type, count(*) AS n FROM ev GROUP BY ALL")
def _(spark, d):
    return counts.counts_of(chain(spark, d), ["program_id", "event_type"])


@query("events_by_month", BASE + "SELECT program_id, date_trunc('month', snap_date)::DATE AS month, count(*) FILTER (WHERE event_type = 'authorized') AS entries, count(*) FILTER (WHERE event_type = 'disappeared_from_roster') AS exits FROM ev GROUP BY ALL")
def _(spark, d):
    return counts.entries_and_exits(chain(spark, d), ["program_id", F.trunc("snap_date", "month").alias("month")])


@query("entry_exit_rate", BASE + """, s AS (SELECT program_id, snap_date, sum(CASE event_type WHEN 'authorized' THEN 1 WHEN 'disappeared_from_roster' THEN -1 ELSE 0 END) AS c,
  count(*) FILTER (WHERE event_type = 'authorized') AS e, count(*) FILTER (WHERE event_type = 'disappeared_from_roster') AS x FROM ev GROUP BY ALL),
r AS (SELECT *, sum(c) OVER (PARTITION BY program_id ORDER BY snap_date) AS size FROM s)
SELECT program_id, round(sum(e) / avg(size), 6) AS entry_rate, round(sum(x) / avg(size), 6) AS exit_rate FROM r GROUP BY program_id""")
def _(spark, d):
    e = log(spark, d)
    return counts.entry_exit_rates(e, status.net_roster(e))


@query("snapshot_depth", f"WITH {OBS}, {SNAPS} SELECT program_id, count(*) AS n_snapshots, min(snap_date) AS earliest FROM snaps GROUP BY 1")
def _(spark, d):
    return counts.snapshot_depth(snapshots(roster_observations(spark, d)))


@query("seen_range", f"""WITH {OBS}, {SNAPS}, r AS (SELECT program_id, provider_id, min(seq) AS a, max(seq) AS b FROM obs JOIN snaps USING (program_id, snap_date) GROUP BY ALL)
SELECT r.program_id, provider_id, x.snap_date AS first_seen, y.snap_date AS last_seen FROM r LEFT JOIN snaps x ON x.program_id = r.program_id AND x.seq = a LEFT JOIN snaps y ON y.program_id = r.program_id AND y.seq = b""")
def _(spark, d):
    obs = roster_observations(spark, d)
    return counts.seen_range(obs, snapshots(obs))


@query("event_sample", BASE + """, e AS (SELECT * FROM ev WHERE event_type = 'authorized' ORDER BY snap_date, event_id LIMIT 20)
SELECT e.event_id, e.provider_id, e.snap_date, o.status AS shown, s.seq AS snapshot_seq FROM e LEFT JOIN seen o ON o.program_id = e.program_id AND o.provider_id = e.provider_id AND o.seq = e.seq LEFT JOIN snaps s ON s.snapshot_id = e.snapshot_id AND s.program_id = e.program_id""")
def _(spark, d):
    obs = roster_observations(spark, d)
    snaps = snapshots(obs)
    shown = obs.join(snaps, ["program_id", "snap_date"]).groupBy("program_id", "provider_id").agg(F.map_from_entries(F.collect_list(F.struct("snap_date", "status"))).alias("shown"))
    e = counts.event_sample(chain(spark, d), shown, snaps.select("program_id", "snapshot_id", F.col("seq").alias("snapshot_seq")), time="snap_date")
    return e.select("event_id", "provider_id", "snap_date", F.try_element_at("shown", "snap_date").alias("shown"), "snapshot_seq")


@query("date_range", "SELECT event_type, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1")
def _(spark, d):
    return counts.time_range(table(spark, d, "events"), ["event_type"], "ts", "first_ts", "last_ts")


@query("first_seen_dedup", """SELECT user_id, event_type, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CASE event_type WHEN 'purchase' THEN 0 WHEN 'click' THEN 1 ELSE 2 END, ts, event_id) = 1""")
def _(spark, d):
    rank = F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "click", 1).otherwise(2)
    return counts.preferred_rows(table(spark, d, "events"), ["user_id"], rank, ["ts", "event_id"]).select("user_id", "event_type", "ts")
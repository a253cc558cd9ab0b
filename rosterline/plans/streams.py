"""Queries that replay the given tables as streams: rosters by micro-batch, keyed state, late captures, versions of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import versions
from ..sources.scratch import new_path
from ..sources.tables import roster_observations, snapshots, table
from ..streaming import incremental, keyed
from .diffs import BASE
from .histories import IN_TIME
from .registry import query

SEEN = "CAST(provider_id AS VARCHAR) AS provider_id"


def _rosters(spark, d) -> DataFrame:
    """The roster chain as rows of a stream (``incremental.ROSTER``), and the day of each."""
    obs = roster_observations(spark, d)
    seen = obs.join(snapshots(obs).select("program_id", "snap_date", "snapshot_id"), ["program_id", "snap_date"])
    return seen.select("program_id", F.col("provider_id").cast("string").alias("provider_id"), "status", "snapshot_id", F.col("snap_date").cast("timestamp").alias("retrieved_at"), "snap_date")


def _files(rows: DataFrame, folder: str, days: int = 6) -> DataFrame:
    """A stream that brings the rows of so many days at a time, in order of time."""
    spark = rows.sparkSession
    path = new_path(spark, "days")
    marked = rows.withColumn("_k", F.floor(F.datediff("snap_date", F.lit("2024-01-01").cast("date")) / days))
    marked.write.parquet(path)  # made once and by all tasks: each file below has one writer
    made = spark.read.schema(marked.schema).parquet(path)
    for (k,) in sorted(made.select("_k").distinct().collect()):
        made.filter(F.col("_k") == k).drop("_k", "snap_date").coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.drop("snap_date").schema).option("maxFilesPerTrigger", 1).parquet(folder)


def _ingested(spark, d) -> str:
    folder = new_path(spark, "ingested")
    incremental.ingest(_files(_rosters(spark, d), f"{folder}-in"), folder).trigger(availableNow=True).start().awaitTermination()
    return folder


@query("stream_events", BASE + f"SELECT program_id, {SEEN}, event_type, new_status, detail, snapshot_id, snap_date FROM ev")
def _(spark, d):
    folder = _ingested(spark, d)
    return spark.read.schema(incremental.EVENTS).parquet(f"{folder}/events").select("program_id", "provider_id", "event_type", "new_status", "detail", "snapshot_id", F.to_date("retrieved_at").alias("snap_date"))


@query("stream_entities", BASE + f""", last AS (SELECT program_id, max(seq) AS last FROM snaps GROUP BY 1), st AS (SELECT program_id, provider_id, max_by(new_status, (snap_date, event_id)) AS current_status FROM ev GROUP BY ALL)
SELECT program_id, {SEEN}, max_by(status, seq) AS status, min(snap_date) AS first_seen, max(snap_date) AS last_seen, max(seq) = any_value(last) AS in_roster, any_value(current_status) AS current_status
FROM seen JOIN last USING (program_id) JOIN st USING (program_id, provider_id) GROUP BY program_id, seen.provider_id""")
def _(spark, d):
    e = incremental.current_entities(spark, _ingested(spark, d))
    return e.select("program_id", "provider_id", "status", F.to_date("first_seen").alias("first_seen"), F.to_date("retrieved_at").alias("last_seen"), "in_roster", "current_status")


@query("stream_late_captures", BASE + f"SELECT program_id, {SEEN}, event_type, new_status, detail, snapshot_id, snap_date FROM ev")
def _(spark, d):
    rows, folder = _rosters(spark, d), new_path(spark, "ingested")
    both = (rows.filter(IN_TIME), rows.filter(f"not ({IN_TIME})"))
    for part, days in zip(both, (10, 366)):
        incremental.ingest(_files(part, f"{folder}-in", days), folder).trigger(availableNow=True).start().awaitTermination()
    return incremental.current_log(spark, folder).select("program_id", "provider_id", "event_type", "new_status", "detail", "snapshot_id", F.to_date("retrieved_at").alias("snap_date"))


@query("stream_keyed_events", BASE + f"SELECT program_id, {SEEN}, event_type, new_status, detail, snapshot_id, snap_date FROM ev")
def _(spark, d):
    entries = F.array_sort(F.collect_list(F.struct("provider_id", "status"))).alias("entries")
    captures = _rosters(spark, d).groupBy("program_id", "snapshot_id", "retrieved_at", "snap_date").agg(entries)
    folder = new_path(spark, "keyed")
    with keyed.keyed_state(spark):
        events = keyed.roster_events(_files(captures, f"{folder}-in"), 4)
        events.writeStream.format("parquet").option("checkpointLocation", f"{folder}-progress").trigger(availableNow=True).start(folder).awaitTermination()
    return spark.read.parquet(folder).select("program_id", "provider_id", "event_type", "new_status", "detail", "snapshot_id", F.to_date("retrieved_at").alias("snap_date"))


@query("stream_changed_captures", """WITH c AS (SELECT event_type AS program_id, ts, max(props) AS sha256 FROM events GROUP BY ALL)
SELECT program_id, sha256, ts AS retrieved_at FROM c QUALIFY lag(sha256) OVER (PARTITION BY program_id ORDER BY ts) IS DISTINCT FROM sha256""")
def _(spark, d):
    captures = table(spark, d, "events").groupBy(F.col("event_type").alias("program_id"), F.col("ts").cast("timestamp").alias("retrieved_at")).agg(F.max("props").alias("sha256"))
    folder = new_path(spark, "changed")
    changed = incremental.changed_captures(_files(captures.withColumn("snap_date", F.to_date("retrieved_at")), f"{folder}-in", 10))
    changed.writeStream.format("parquet").option("checkpointLocation", f"{folder}-progress").trigger(availableNow=True).start(folder).awaitTermination()
    return spark.read.parquet(folder).select("program_id", "sha256", F.col("retrieved_at").cast("timestamp_ntz").alias("retrieved_at"))


@query("stream_event_counts", """SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events
WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events) GROUP BY 1, 2""")
def _(spark, d):
    """Days that the watermark has closed."""
    folder = new_path(spark, "counts")
    rows = table(spark, d, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"), F.to_date("ts").alias("snap_date"))
    incremental.event_counts(_files(rows, f"{folder}-in", 10)).writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{folder}-progress").trigger(availableNow=True).start(folder).awaitTermination()
    return spark.read.parquet(folder).select(F.to_date("window_start").alias("day"), "event_type", "n")


@query("table_versions", """SELECT 1 AS version, o_orderpriority, count(*) AS n, min(o_orderkey) AS least FROM orders GROUP BY ALL
UNION ALL SELECT 2, o_orderpriority, count(*), min(o_orderkey) FROM orders WHERE o_orderpriority NOT LIKE '1%' OR o_orderstatus = 'F' GROUP BY ALL""")
def _(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    schema, folder = "o_orderkey long, o_orderpriority string, o_orderstatus string", new_path(spark, "versions")
    one = versions.commit(orders, folder, "o_orderpriority", versions.NONE)
    two = versions.commit(orders.filter("o_orderpriority like '1%' and o_orderstatus = 'F'"), folder, "o_orderpriority", one)
    counted = lambda v: versions.read_version(spark, folder, schema, version=v).groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("least")).withColumn("version", F.lit(v.number))
    return counted(one).unionByName(counted(two))

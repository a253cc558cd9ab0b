"""Events out of rosters: two snapshots compared, and whole chains at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.names import event_id
from .sizes import broadcast_if_small


def last_in_roster(roster: DataFrame, keys: tuple[str, ...] = ("program_id", "provider_id"), order: str = "row_no") -> DataFrame:
    """Of rows with one key in a roster, the last."""
    return roster.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))).filter("_r = 1").drop("_r")


def snapshot_diff(old: DataFrame, new: DataFrame, by: tuple[str, ...] = ("program_id", "provider_id"), status: str = "status") -> DataFrame:
    """Events between two rosters: entries with their own status, exits, and changes of status with 'old → new' as detail."""
    a = old.select(*by, F.col(status).alias("_old"), F.lit(True).alias("_was"))
    b = new.select(*by, F.col(status).alias("_new"), F.lit(True).alias("_is"))
    both = a.join(b, list(by), "full_outer")
    kind = F.when(F.col("_was").isNull(), "authorized").when(F.col("_is").isNull(), "disappeared_from_roster").when(~F.col("_old").eqNullSafe(F.col("_new")), "status_change")
    return both.withColumn("event_type", kind).filter("event_type is not null").select(
        *by, "event_type", F.when(F.col("_is").isNull(), "exited").otherwise(F.col("_new")).alias("new_status"),
        F.when(F.col("event_type") == "status_change", F.concat_ws(" → ", "_old", "_new")).alias("detail"),
    )


def diff_chain(observations: DataFrame, snaps: DataFrame, time: str = "snap_date") -> DataFrame:
    """All events of all programs: (program_id, provider_id, seq, event_type, new_status, detail, snapshot time and id).

    Each observation looks at the one before and the one after it of the same provider. A gap in the program's snapshots
    after it is an exit at the next snapshot, also if that is empty; a gap before it is an entry. Observations are shuffled
    once, by provider, so a program that holds most of them is spread. Snapshots carry the next one with them and are
    joined once; they are broadcast where they are few.
    """
    in_order = Window.partitionBy("program_id").orderBy("seq")
    step = lambda when, at, id_: F.struct(F.col(when).alias("seq"), F.col(at).alias(time), F.col(id_).alias("snapshot_id"))
    known = snaps.select("program_id", time, "seq", "snapshot_id", F.lead("seq").over(in_order).alias("_s"), F.lead(time).over(in_order).alias("_t"), F.lead("snapshot_id").over(in_order).alias("_i"))
    known = known.select("program_id", time, "seq", step("seq", time, "snapshot_id").alias("_here"), F.when(F.col("_s").isNotNull(), step("_s", "_t", "_i")).alias("_next"))
    seen = observations.select("program_id", "provider_id", time, "status").join(broadcast_if_small(known), ["program_id", time])
    by = Window.partitionBy("program_id", "provider_id").orderBy("seq")
    seen = seen.select("program_id", "provider_id", "seq", "status", "_here", "_next", F.lag("seq").over(by).alias("_before"), F.lead("seq").over(by).alias("_after"), F.lag("status").over(by).alias("_old"))
    fresh = F.col("_before").isNull() | (F.col("_before") < F.col("seq") - 1)
    event = lambda when, at, kind, new, detail: F.when(when, F.struct(F.col(at).alias("at"), F.lit(kind).alias("event_type"), new.alias("new_status"), detail.cast("string").alias("detail")))
    entry = event(fresh, "_here", "authorized", F.col("status"), F.lit(None))
    change = event(~fresh & ~F.col("_old").eqNullSafe(F.col("status")), "_here", "status_change", F.col("status"), F.concat_ws(" → ", "_old", "status"))
    gone = F.col("_next").isNotNull() & (F.col("_after").isNull() | (F.col("_after") > F.col("seq") + 1))
    exit_ = event(gone, "_next", "disappeared_from_roster", F.lit("exited"), F.lit(None))
    events = seen.select("program_id", "provider_id", F.explode(F.filter(F.array(entry, change, exit_), lambda e: e.isNotNull())).alias("e"))
    return events.select("program_id", "e.at.seq", "provider_id", "e.event_type", "e.new_status", "e.detail", f"e.at.{time}", "e.at.snapshot_id")


def with_event_id(events: DataFrame) -> DataFrame:
    return events.withColumn("event_id", event_id(F.col("provider_id").cast("string"), F.col("snapshot_id"), F.col("event_type")))


def consecutive_dedup(captures: DataFrame, key: str, order: list, content: str) -> DataFrame:
    """captures without those whose content equals that of the one before; A, B, A stays whole."""
    before = F.lag(content).over(Window.partitionBy(key).orderBy(*order))
    return captures.withColumn("_b", before).filter("_b is null or not _b <=> " + content).drop("_b")


def provider_spells(observations: DataFrame, snaps: DataFrame, time: str = "snap_date") -> DataFrame:
    """Runs of consecutive snapshots that hold a provider: first and last time, length in snapshots, days."""
    seen = observations.join(snaps.select("program_id", time, "seq"), ["program_id", time])
    run = F.col("seq") - F.row_number().over(Window.partitionBy("program_id", "provider_id").orderBy("seq"))
    spells = seen.withColumn("_run", run).groupBy("program_id", "provider_id", "_run").agg(F.min(time).alias("start_date"), F.max(time).alias("end_date"), F.count("*").alias("n_snapshots"))
    return spells.drop("_run").withColumn("days", F.datediff("end_date", "start_date"))


def grace_window(events: DataFrame, snapshots_off: int) -> DataFrame:
    """events without exits that a return within so many snapshots takes back, and without those returns."""
    by = Window.partitionBy("program_id", "provider_id").orderBy("seq", F.when(F.col("event_type") == "disappeared_from_roster", 1).otherwise(0))
    near = lambda a, b: F.coalesce(a - b <= snapshots_off, F.lit(False))
    next_kind, next_seq, last_kind, last_seq = F.lead("event_type").over(by), F.lead("seq").over(by), F.lag("event_type").over(by), F.lag("seq").over(by)
    exit_back = (F.col("event_type") == "disappeared_from_roster") & (next_kind == "authorized") & near(next_seq, F.col("seq"))
    entry_back = (F.col("event_type") == "authorized") & (last_kind == "disappeared_from_roster") & near(F.col("seq"), last_seq)
    return events.withColumn("_off", F.coalesce(exit_back, F.lit(False)) | F.coalesce(entry_back, F.lit(False))).filter("not _off").drop("_off")


def backfill_authorized(providers: DataFrame, snaps: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """One entry event for each provider at its first snapshot, unless the log has that event already."""
    first = providers.join(snaps.select(F.col("snapshot_id").alias("first_seen_snapshot_id"), F.col("snap_date").alias("event_date")), "first_seen_snapshot_id")
    out = first.select(
        event_id(F.col("provider_id").cast("string"), F.col("first_seen_snapshot_id"), F.lit("authorized")).alias("event_id"), "provider_id", "event_date", F.lit("authorized").alias("event_type"),
        F.col("current_status").alias("new_status"), F.lit("First observed on the roster").alias("detail"), F.col("first_seen_snapshot_id").alias("snapshot_id"),
    )
    return out if events is None else out.join(events.select("event_id").distinct(), "event_id", "left_anti")

"""Late captures: what a snapshot that arrives after its successors changes in an event log."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .diff import with_event_id
from .sizes import broadcast_if_small
from .status import recompute_status

#: What an event is, besides its snapshot's place in the chain, which late captures shift.
EVENT = ("program_id", "provider_id", "event_type", "new_status", "detail", "snapshot_id")


@dataclass
class Revision:
    """Events to take out of a log and to put in, by event id, and the captures of the chain with their new order."""

    retractions: DataFrame
    insertions: DataFrame
    snapshots: DataFrame


def neighbours(kept: DataFrame, late: DataFrame, time: str = "snap_date") -> DataFrame:
    """Captures of the whole chain with ``seq``, ``was_late``, the capture ``before`` each, and whether the events at it can change.

    They can at a late capture and at the one right after one, whose predecessor it now is. A capture that is in both
    tables was kept already, so late captures that arrive again change nothing.
    """
    own = ["program_id", time, "snapshot_id"]
    every = kept.select(*own, F.lit(False).alias("l")).unionByName(late.select(*own, F.lit(True).alias("l"))).groupBy(*own).agg(F.min("l").alias("was_late"))
    chain = Window.partitionBy("program_id").orderBy(time, "snapshot_id")
    return every.select(
        *own, F.row_number().over(chain).alias("seq"), "was_late", F.lag(time).over(chain).alias("before"),
        (F.col("was_late") | F.coalesce(F.lag("was_late").over(chain), F.lit(False))).alias("open"),
    )


def revise(log: DataFrame, observations: DataFrame, kept: DataFrame, late_observations: DataFrame, late: DataFrame, time: str = "snap_date", names: Callable[[DataFrame], DataFrame] = with_event_id) -> Revision:
    """The revision of ``log``, the events of the chain of ``kept`` captures, by ``late`` ones.

    observations and late_observations: program_id, provider_id, time, status. kept and late: program_id, time,
    snapshot_id. log: the columns of ``EVENT``, the time and event_id, as ``names`` gives it.

    A late capture L between P and N adds the events from P to L and replaces those from P to N by those from L to N; all
    others stay. So only rosters of the late captures and of their neighbours are read: each observation goes to the pair
    of captures that it ends and to the one that it begins, and one aggregate by program, provider and pair gives the new
    events. Events that the log has already are in neither part. Late captures before the first and after the last
    one, several in a row, empty ones, and programs that the log doesn't know are the same case.

    Captures are one row each and broadcast where they are few; rosters are shuffled by provider, so a program with most
    rows is spread. Of equal observations one counts. Null statuses are statuses.
    """
    chain = neighbours(kept, late, time)
    open_ = chain.filter("open")
    step = lambda at, role: F.struct(F.col(at).alias("at"), F.lit(role).alias("role"))
    roles = (
        open_.select("program_id", F.col(time).alias("_at"), step(time, "new").alias("part"))
        .unionByName(open_.filter("before is not null").select("program_id", F.col("before").alias("_at"), step(time, "old").alias("part")))
        .groupBy("program_id", "_at").agg(F.collect_list("part").alias("parts")).withColumnRenamed("_at", time)
    )
    rows = observations.select("program_id", "provider_id", time, "status").unionByName(late_observations.select("program_id", "provider_id", time, "status"))
    seen = rows.join(broadcast_if_small(roles), ["program_id", time]).select("program_id", "provider_id", "status", F.explode("parts").alias("part"))
    side = lambda role: F.max(F.when(F.col("part.role") == role, F.struct("status"))).alias(role)
    pairs = seen.groupBy("program_id", "provider_id", F.col("part.at").alias(time)).agg(side("old"), side("new"))
    kind = F.when(F.col("old").isNull(), "authorized").when(F.col("new").isNull(), "disappeared_from_roster").when(~F.col("old.status").eqNullSafe(F.col("new.status")), "status_change")
    changed = pairs.withColumn("event_type", kind).filter("event_type is not null").select(
        "program_id", "provider_id", time, "event_type", F.when(F.col("new").isNull(), "exited").otherwise(F.col("new.status")).alias("new_status"),
        F.when(F.col("event_type") == "status_change", F.concat_ws(" → ", "old.status", "new.status")).alias("detail"),
    )
    places = broadcast_if_small(open_.select("program_id", time, "snapshot_id"))
    after = names(changed.join(places, ["program_id", time])).select(*EVENT, time, "event_id")
    before = log.join(broadcast_if_small(open_.filter("not was_late").select("program_id", time)), ["program_id", time], "left_semi").select(*EVENT, time, "event_id")
    # Signed: an event that is in both with the same contents cancels out.
    signed = after.withColumn("_sign", F.lit(1)).unionByName(before.withColumn("_sign", F.lit(-1)))
    net = signed.groupBy(*EVENT, time, "event_id").agg(F.sum("_sign").alias("_net"))
    part = lambda sign: net.filter(F.col("_net") * sign > 0).drop("_net")
    return Revision(part(-1), part(1), chain.select("program_id", time, "snapshot_id", "seq"))


def rosters_at(log: DataFrame, captures: DataFrame, time: str = "snap_date") -> DataFrame:
    """Observations (program_id, provider_id, time, status) of the rosters at some captures, from the log alone.

    An event holds until the provider's next one; each capture takes the events that hold at it, other than exits. For a log
    without gaps: every change of a roster has its event.
    """
    by = Window.partitionBy("program_id", "provider_id").orderBy(time, F.when(F.col("event_type") == "disappeared_from_roster", 0).otherwise(1))
    held = log.select("program_id", "provider_id", "event_type", F.col("new_status").alias("status"), F.col(time).alias("_from"), F.lead(time).over(by).alias("_to"))
    at = broadcast_if_small(captures.select("program_id", time).distinct())
    covers = (F.col("_from") <= F.col(time)) & (F.col("_to").isNull() | (F.col("_to") > F.col(time)))
    return held.filter("event_type <> 'disappeared_from_roster'").join(at, "program_id").filter(covers).select("program_id", "provider_id", time, "status")


def apply_revision(log: DataFrame, revision: Revision) -> DataFrame:
    """The log after a revision. Applied again it changes nothing: what is retracted is gone, what is put in is there."""
    gone = revision.retractions.select("event_id").unionByName(revision.insertions.select("event_id"))
    return log.join(gone, "event_id", "left_anti").unionByName(revision.insertions, allowMissingColumns=True)


def revised_status(entities: DataFrame, log: DataFrame, revision: Revision, keys: tuple[str, str] = ("program_id", "provider_id")) -> DataFrame:
    """entities with the current status of those that a revision touches, from their events in the revised ``log``; others stay."""
    touched = revision.retractions.select(*keys).unionByName(revision.insertions.select(*keys)).distinct()
    marked = entities.join(touched.withColumn("_touched", F.lit(True)), list(keys), "left")
    fresh = recompute_status(marked.filter("_touched"), log.join(touched, list(keys), "left_semi"), keys)
    return marked.filter("_touched is null").unionByName(fresh).drop("_touched")

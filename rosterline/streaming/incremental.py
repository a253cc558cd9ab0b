"""Rosters as they arrive: incremental events, unchanged captures, counts over event time, late captures."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.window import Window

from ..functions.names import event_id
from ..operators.diff import consecutive_dedup, diff_chain
from ..operators.merge import merge_first_seen
from ..operators.revise import Revision, apply_revision, neighbours, revise, rosters_at
from ..operators.status import recompute_status
from ..sources.versions import collect_old, commit, latest, parts_of, read_version

ROSTER = "program_id string, provider_id string, status string, snapshot_id string, retrieved_at timestamp"
EVENTS = "event_id string, program_id string, provider_id string, event_type string, new_status string, detail string, snapshot_id string, retrieved_at timestamp"


def batch_events(batch: DataFrame, current: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, next rosters) of one batch of observations against the last roster of each program.

    A batch may hold several captures of a program: each is compared with the one before it, the first with the last
    roster. A capture that is older than a program's last one is late and left to the backfill (see ``split_late``).
    """
    fresh, _ = split_late(batch, current.select("program_id", "retrieved_at"))
    touched = current.join(fresh.select("program_id").distinct(), "program_id", "left_semi")
    both = touched.unionByName(fresh).dropDuplicates(["program_id", "provider_id", "retrieved_at"])
    snaps = both.select("program_id", "retrieved_at", "snapshot_id").distinct()
    snaps = snaps.withColumn("seq", F.row_number().over(Window.partitionBy("program_id").orderBy("retrieved_at", "snapshot_id")))
    known = touched.select("program_id", "retrieved_at").distinct().withColumn("_old", F.lit(True))
    events = diff_chain(both, snaps, "retrieved_at").join(known, ["program_id", "retrieved_at"], "left").filter("_old is null").drop("_old")
    events = _with_ids(events)
    last = snaps.groupBy("program_id").agg(F.max("retrieved_at").alias("retrieved_at"))
    rest = current.join(last.select("program_id"), "program_id", "left_anti")
    return events.select(*[c.split()[0] for c in EVENTS.split(", ")]), rest.unionByName(both.join(last, ["program_id", "retrieved_at"], "left_semi").select(*current.columns))


def _with_ids(events: DataFrame) -> DataFrame:
    """Event ids that tell programs and times apart, since the same bytes have the same snapshot id wherever they come again."""
    return events.withColumn("event_id", event_id(F.col("provider_id"), F.concat_ws("@", "program_id", F.col("retrieved_at").cast("string"), "snapshot_id"), F.col("event_type")))


def split_late(batch: DataFrame, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows newer than the program's last kept capture, late rows for the backfill)."""
    last = kept.groupBy("program_id").agg(F.max("retrieved_at").alias("_last"))
    marked = batch.join(last, "program_id", "left")
    late = F.coalesce(F.col("retrieved_at") <= F.col("_last"), F.lit(False))
    return marked.filter(~late).drop("_last"), marked.filter(late).drop("_last")


ENTITIES = (
    "program_id string, provider_id string, status string, snapshot_id string, retrieved_at timestamp, first_snapshot_id string, first_seen timestamp, "
    "in_roster boolean, current_status string"
)
CAPTURES = "program_id string, retrieved_at timestamp, snapshot_id string"
_KEYS = ["program_id", "provider_id"]


def merged_entities(entities: DataFrame, batch: DataFrame, events: DataFrame) -> DataFrame:
    """Entities (``ENTITIES``) of the programs of a batch after it: first-seen fields stay, the last roster and status are its own.

    ``in_roster`` tells who is in the program's last capture; the current status is that of an entity's last event.
    """
    fresh, _ = split_late(batch, entities.filter("in_roster").select("program_id", "retrieved_at"))
    incoming = fresh.select(*_KEYS, "status", "snapshot_id", "retrieved_at", F.col("snapshot_id").alias("first_snapshot_id"), F.col("retrieved_at").alias("first_seen"), F.lit(True).alias("in_roster"), F.col("status").alias("current_status"))
    merged = merge_first_seen(entities, incoming, _KEYS, ["first_snapshot_id", "first_seen"], order=["retrieved_at", "snapshot_id"])
    last = fresh.groupBy("program_id").agg(F.max("retrieved_at").alias("_last"))
    placed = merged.join(last, "program_id", "left").withColumn("in_roster", F.when(F.col("_last").isNotNull(), F.col("retrieved_at") == F.col("_last")).otherwise(F.col("in_roster"))).drop("_last")
    known = recompute_status(placed, events.withColumn("event_date", F.col("retrieved_at")), _KEYS)
    return known.select(*[c.split()[0] for c in ENTITIES.split(", ")])


def ingest(stream: DataFrame, folder: str, keep: int = 2) -> DataStreamWriter:
    """Start of a stream of observations (``ROSTER``) that appends events and captures and keeps entities under ``folder``.

    A batch reads and writes the entities of the programs that it brings and no others (see ``sources.versions``). Events,
    captures and late rows go to a folder of the batch, which a rerun writes again; the version of the entities, which
    carries the batch's number, is committed last. So a batch that failed half way starts from the same version again, one
    that is run again after its commit changes nothing, and a lost version stops the stream. Late rows are for
    ``late_revision``. The driver holds the names of a batch's programs.
    """

    def each(batch: DataFrame, number: int) -> None:
        spark, table = batch.sparkSession, f"{folder}/entities"
        base = latest(spark, table)
        if base.mark is not None and base.mark >= number:
            return
        if (base.mark if base.number else -1) != number - 1:
            raise ValueError(f"entities of batch {number - 1} are lost")
        batch = batch.persist()
        try:
            programs = [r[0] for r in batch.select("program_id").distinct().collect()]
            own = read_version(spark, table, ENTITIES, parts_of(programs), base)
            before = own.filter("in_roster").select(*[c.split()[0] for c in ROSTER.split(", ")])
            fresh, late = split_late(batch, before.select("program_id", "retrieved_at"))
            late.write.mode("overwrite").parquet(f"{folder}/late/v={number}")
            fresh.select("program_id", "retrieved_at", "snapshot_id").distinct().write.mode("overwrite").parquet(f"{folder}/captures/v={number}")
            batch_events(batch, before)[0].write.mode("overwrite").parquet(f"{folder}/events/v={number}")
            events = spark.read.schema(EVENTS).parquet(f"{folder}/events/v={number}")
            commit(merged_entities(own, batch, events), table, "program_id", base, number)
            collect_old(spark, table, keep)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{folder}/progress")


def current_entities(spark: SparkSession, folder: str) -> DataFrame:
    return read_version(spark, f"{folder}/entities", ENTITIES)


def late_revision(spark: SparkSession, folder: str) -> Revision:
    """What the late rows that ``ingest`` put aside change in its events: see ``operators.revise``.

    Rosters of the neighbouring captures come from the events, so nothing but what ``ingest`` keeps is read.
    """
    log = spark.read.schema(EVENTS).parquet(f"{folder}/events")
    kept = spark.read.schema(CAPTURES).parquet(f"{folder}/captures")
    late = spark.read.schema(ROSTER).parquet(f"{folder}/late")
    arrived = late.select("program_id", "retrieved_at", "snapshot_id").distinct()
    chain = neighbours(kept, arrived, "retrieved_at")
    open_ = chain.filter("open")
    needed = open_.select("program_id", "retrieved_at").unionByName(open_.filter("before is not null").select("program_id", F.col("before").alias("retrieved_at")))
    known = rosters_at(log, needed.join(kept.select("program_id", "retrieved_at"), ["program_id", "retrieved_at"], "left_semi"), "retrieved_at")
    rows = late.join(kept.select("program_id", "retrieved_at"), ["program_id", "retrieved_at"], "left_anti").dropDuplicates([*_KEYS, "retrieved_at"])
    return revise(log, known, kept, rows, arrived, "retrieved_at", _with_ids)


def current_log(spark: SparkSession, folder: str) -> DataFrame:
    """The events of all captures, late ones at their place."""
    return apply_revision(spark.read.schema(EVENTS).parquet(f"{folder}/events"), late_revision(spark, folder))


def unchanged_dedup(captures: DataFrame, last: DataFrame, program: str = "program_id", content: str = "sha256", time: str = "retrieved_at") -> DataFrame:
    """Captures of a batch whose content differs from the program's capture before, in the batch or in ``last``; A, B, A stays."""
    both = captures.withColumn("_new", F.lit(True)).unionByName(last.select(*captures.columns).withColumn("_new", F.lit(False)))
    return consecutive_dedup(both, program, [time], content).filter("_new").drop("_new")


def changed_captures(captures: DataFrame, program: str = "program_id", content: str = "sha256", time: str = "retrieved_at", late: str = "7 days") -> DataFrame:
    """Of a stream of captures (program, content hash, time) those whose content differs from the program's one before.

    The state is the last hash and time of each program, so A, B, A stays, unlike with dropped duplicates. Captures of a
    batch count in order of time; one older than the program's last is left out, as the backfill has it.
    """

    def each(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, at = state.get if state.exists else (None, None)
        rows = pd.concat(frames).sort_values([time, content], kind="stable")
        keep = []
        for i, (value, when) in enumerate(zip(rows[content], rows[time])):
            if at is not None and when.to_pydatetime() <= at:
                continue
            if value != last:
                keep.append(i)
            last, at = value, when.to_pydatetime()
        if at is not None:
            state.update((last, at))
        yield rows.iloc[keep][[program, content, time]]

    schema = f"{program} string, {content} string, {time} timestamp"
    grouped = captures.select(F.col(program).cast("string").alias(program), content, time).withWatermark(time, late).groupBy(program)
    return grouped.applyInPandasWithState(each, schema, "last string, at timestamp", "append", GroupStateTimeout.NoTimeout)


def event_counts(events: DataFrame, time: str = "ts", program: str = "event_type", width: str = "1 day", late: str = "1 day") -> DataFrame:
    """Counts by program and window of event time; works on streams and on tables."""
    counted = events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), program).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), program, "n")

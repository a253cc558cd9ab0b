"""Status over time: current, as of a date, running counts, histories, gaps."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import new_path
from .sizes import broadcast_if_small


def recompute_status(entities: DataFrame, events: DataFrame, key: str | Sequence[str] = "provider_id", status: str = "current_status") -> DataFrame:
    """entities with the status of their last event by (date, event id); without events they keep theirs. ``key`` may be several columns."""
    key = [key] if isinstance(key, str) else list(key)
    last = events.groupBy(*key).agg(F.max_by("new_status", F.struct("event_date", "event_id")).alias("_last"))
    return entities.join(last, key, "left").withColumn(status, F.coalesce("_last", status)).drop("_last")


def status_asof(events: DataFrame, dates: DataFrame, program: str = "program_id", key: str = "provider_id") -> DataFrame:
    """(as_of, program, status, n): how many providers had which status at the end of each date; combinations without any are left out.

    Each event holds until the provider's next one. It adds one to its program and status at its own date and takes one away
    at the next event's, so counts change at change points only. Change points are moved to the first wanted date from
    theirs on, added up there, and a running sum gives the count from each to the next. So an interval is two rows
    however many dates it covers, and the only rows by date are those of the result.

    Dates are put in order once, with the different dates of events, in one task: there are as many as days. Repeated dates
    count once, null ones are left out.
    """
    by = Window.partitionBy(program, key).orderBy("event_date", "event_id")
    held = events.select(program, F.col("new_status").alias("status"), "event_date", F.lead("event_date").over(by).alias("_to"))
    ends = F.array(F.struct(F.col("event_date").alias("day"), F.lit(1).alias("step")), F.struct(F.col("_to").alias("day"), F.lit(-1).alias("step")))
    steps = held.filter("_to is null or _to > event_date").select(program, "status", F.explode(ends).alias("_e")).filter("_e.day is not null")
    days = steps.groupBy(program, "status", F.col("_e.day").alias("day")).agg(F.sum("_e.step").alias("step"))
    path = new_path(days.sparkSession, "days")  # read twice, so that the events are not computed twice
    days.write.parquet(path)
    days = days.sparkSession.read.schema(days.schema).parquet(path)

    wanted = dates.filter("as_of is not null").select("as_of").distinct().select("as_of", F.row_number().over(Window.orderBy("as_of")).alias("_at"))
    every = days.select("day").distinct().select("day", F.lit(None).cast("int").alias("_at")).unionByName(wanted.select(F.col("as_of").alias("day"), "_at"))
    ahead = Window.orderBy("day", F.col("_at").isNotNull()).rowsBetween(0, Window.unboundedFollowing)
    first = every.select("day", F.col("_at").alias("_own"), F.min("_at").over(ahead).alias("_at"), F.max("_at").over(Window.partitionBy()).alias("_last"))
    first = first.filter("_own is null and _at is not null").drop("_own")

    points = days.join(broadcast_if_small(first), "day").groupBy(program, "status", "_at", "_last").agg(F.sum("step").alias("step"))
    along = Window.partitionBy(program, "status").orderBy("_at")
    size = F.sum("step").over(along.rowsBetween(Window.unboundedPreceding, 0))
    runs = points.select(program, "status", "_at", "_last", size.alias("n"), F.lead("_at").over(along).alias("_next")).filter("n > 0")
    spread = runs.select(program, "status", "n", F.explode(F.sequence("_at", F.coalesce(F.col("_next") - 1, "_last"))).alias("_at"))
    return spread.join(broadcast_if_small(wanted), "_at").select("as_of", program, "status", "n")


def net_roster(events: DataFrame, program: str = "program_id", day: str = "event_date") -> DataFrame:
    """(program, date, change, size): entries less exits of a day, and the running sum."""
    step = F.when(F.col("event_type") == "authorized", 1).when(F.col("event_type") == "disappeared_from_roster", -1).otherwise(0)
    days = events.groupBy(program, day).agg(F.sum(step).alias("change"))
    return days.withColumn("size", F.sum("change").over(Window.partitionBy(program).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)))


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is last by ``order``."""
    return _one(df, keys, order, F.max_by)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _one(df, keys, order, F.min_by)


def _one(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_x")).select(*keys, "_x.*")


def capture_gaps(captures: DataFrame, key: str, time: str, days: int = 90) -> DataFrame:
    """(key, from, to, days) between consecutive captures more than so many days apart."""
    before = F.lag(time).over(Window.partitionBy(key).orderBy(time))
    gaps = captures.select(key, before.alias("gap_from"), F.col(time).alias("gap_to"))
    return gaps.withColumn("gap_days", F.datediff("gap_to", "gap_from")).filter(F.col("gap_days") > days)


def bridge_gap(history: DataFrame, own: DataFrame, key: str, time: str, days: int = 90) -> DataFrame:
    """The gap from the last historical capture to the first own one, where longer than so many days."""
    a, b = history.groupBy(key).agg(F.max(time).alias("gap_from")), own.groupBy(key).agg(F.min(time).alias("gap_to"))
    return a.join(b, key).withColumn("gap_days", F.datediff("gap_to", "gap_from")).filter(F.col("gap_days") > days)


def event_history(events: DataFrame, key: str, *fields: str) -> DataFrame:
    """One ordered array of events for each key."""
    return events.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("history"))


_IDS = 32_768  # ids of a bitmap


def _gaps_inside(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """First and last id of each bitmap and the gaps between; only bytes with a bit are looked at."""
    for frame in frames:
        out = []
        for part, data in zip(frame["part"], frame["map"]):
            held = np.frombuffer(data, np.uint8)
            full = np.flatnonzero(held)
            row, bit = np.nonzero(np.unpackbits(held[full, None], axis=1, bitorder="little"))
            ids = part * _IDS + full[row] * 8 + bit
            at = np.flatnonzero(np.diff(ids) > 1)
            out.append((part, ids[0], ids[-1], ids[at] + 1, ids[at + 1] - 1))
        yield pd.DataFrame(out, columns=["part", "first", "last", "starts", "ends"])


def sequence_gaps(df: DataFrame, col: str) -> DataFrame:
    """(gap_start, gap_end) of whole numbers that a rising sequence leaves out, between its least and its greatest id.

    Ids become bits of one bitmap for each range of 32,768, built before they are shuffled: a task sends at most 4 kB for
    each range that it has seen, however many ids, and repeated ids set the same bit. Gaps inside a range are read from
    its bitmap, gaps between ranges from their first and last ids: ranges are put in order in groups of 32,768, and groups
    by their edges, which are one row for each 2^30 ids. Null ids are left out; negative ones are ids.
    """
    at = F.col(col).cast("long")
    bits = df.filter(at.isNotNull()).select(F.shiftright(at, 15).alias("part"), F.pmod(at, F.lit(_IDS)).alias("bit"))
    maps = bits.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("map"))
    found = maps.mapInPandas(_gaps_inside, "part long, first long, last long, starts array<long>, ends array<long>")
    gaps = F.zip_with("starts", "ends", lambda a, b: F.struct(a.alias("gap_start"), b.alias("gap_end"))).alias("gaps")
    parts = found.select("part", F.shiftright("part", 15).alias("group"), "first", "last", gaps)
    groups = parts.groupBy("group").agg(F.max("last").alias("end"))
    groups = groups.select("group", F.lag("end").over(Window.orderBy("group")).alias("_before"))
    within = Window.partitionBy("group").orderBy("part")
    edged = parts.withColumn("_lag", F.lag("last").over(within)).join(broadcast_if_small(groups), "group").withColumn("_b", F.coalesce("_lag", "_before"))
    between = F.when(F.col("first") - F.col("_b") > 1, F.array(F.struct((F.col("_b") + 1).alias("gap_start"), (F.col("first") - 1).alias("gap_end"))))
    return edged.select(F.explode(F.concat("gaps", F.coalesce(between, F.slice("gaps", 1, 0)))).alias("g")).select("g.*")


def stratified_sample(df: DataFrame, strata: list[str], key: str, least: int = 15, share: float = 0.1, seed: str = "0") -> DataFrame:
    """Of each stratum the greater of ``least`` rows and its share, chosen by a hash of key and seed.

    Rows are ranked in 256 parts by the first two digits of the hash and the parts counted, so no stratum is sorted in one
    task.
    """
    hashed = df.withColumn("_h", F.sha2(F.concat_ws("|", F.col(key).cast("string"), F.lit(seed)), 256)).withColumn("_part", F.substring("_h", 1, 2))
    parts = hashed.groupBy(*strata, "_part").agg(F.count("*").alias("_k"))
    whole = Window.partitionBy(*strata)
    before = F.coalesce(F.sum("_k").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(strata)], F.col("_part").alias("_p"), before.alias("_before"), F.sum("_k").over(whole).alias("_n"))
    rank = F.row_number().over(Window.partitionBy(*strata, "_part").orderBy("_h", key))
    same = [F.col(c).eqNullSafe(F.col(f"_s{i}")) for i, c in enumerate(strata)]
    ranked = hashed.withColumn("_r", rank).join(parts, [*same, F.col("_part") == F.col("_p")])
    return ranked.filter(F.col("_before") + F.col("_r") <= F.greatest(F.lit(least), F.ceil(F.col("_n") * share))).select(*df.columns)


def roster_at(providers: DataFrame, snapshot: str, last: str = "last_seen_snapshot_id") -> DataFrame:
    """Identifiers and statuses of the providers last seen in a snapshot: the old side of the next diff."""
    return providers.filter(F.col(last) == snapshot).select("program_id", "provider_id", F.col("current_status").alias("status"))

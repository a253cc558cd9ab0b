"""Counts and summaries of rosters, events and labels. All are partial aggregates before they are shuffled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .status import first_per_key

ENTRY, EXIT = "authorized", "disappeared_from_roster"


def counts_of(df: DataFrame, keys: Sequence[str | Column], out: str = "n") -> DataFrame:
    """Rows by key."""
    return df.groupBy(*keys).agg(F.count("*").alias(out))


def zero_filled(parents: DataFrame, children: DataFrame, key: str, out: str = "n") -> DataFrame:
    """parents with how many children each has, 0 included."""
    return parents.join(counts_of(children, [key], out), key, "left").fillna(0, [out])


def counts_by_value(df: DataFrame, keys: Sequence[str], column: str, values: Mapping[str, str], total: str | None = None) -> DataFrame:
    """By key the rows with each of the given values of a column, as columns of the mapped names, and all rows."""
    counts = [F.count_if(F.coalesce(F.col(column) == value, F.lit(False))).alias(name) for value, name in values.items()]
    return df.groupBy(*keys).agg(*([F.count("*").alias(total)] if total else []), *counts)


def totals(tables: Mapping[str, tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    """One row of aggregates over several tables; each table gives one row, and these are put side by side."""
    out = None
    for df, aggregates in tables.values():
        one = df.agg(*[a.alias(name) for name, a in aggregates.items()]).withColumn("_one", F.lit(1))
        out = one if out is None else out.join(one, "_one")
    return out.drop("_one")


def place_rollup(programs: DataFrame, place: str, name: str, n: str) -> DataFrame:
    """By place its programs in order, their providers, whether none has any, and the most that a place has."""
    r = programs.groupBy(place).agg(F.array_sort(F.collect_list(name)).alias("programs"), F.sum(n).alias("providers"), F.bool_and(F.col(n) == 0).alias("all_zero"))
    return with_most(r, "providers", "max_providers")


def with_most(df: DataFrame, n: str, out: str) -> DataFrame:
    """df with the greatest value of a column in all rows: one number, so it is broadcast."""
    return df.join(F.broadcast(df.agg(F.max(n).alias(out))))


def share_of_most(df: DataFrame, n: str, out: str = "share") -> DataFrame:
    """df with each row's part of the greatest count."""
    return with_most(df, n, "_most").withColumn(out, F.round(F.col(n) / F.greatest("_most", F.lit(1)), 6)).drop("_most")


def fill_rate(df: DataFrame, keys: Sequence[str], filled: Column, out: str = "rate") -> DataFrame:
    """By key the share of rows that are filled."""
    return df.groupBy(*keys).agg(F.round(F.avg(F.when(filled, 1.0).otherwise(0.0)), 6).alias(out))


def element_counts(df: DataFrame, array: Column, element: str, out: str = "n") -> DataFrame:
    """How often each element occurs in a column of arrays."""
    return counts_of(df.select(F.explode(array).alias(element)), [element], out)


def label_counts(df: DataFrame, label: Column, name: str = "label", out: str = "n") -> DataFrame:
    """Rows by label, the most frequent first, equal ones by label."""
    return counts_of(df, [label.alias(name)], out).orderBy(F.desc(out), name)


def before_and_after(tables: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """(table_name, before, after): rows of each table, and those that pass its condition."""
    parts = [df.agg(F.count("*").alias("before"), F.count_if(ok).alias("after")).select(F.lit(name).alias("table_name"), "before", "after") for name, (df, ok) in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def rollup_totals(df: DataFrame, key: str, aggregates: Mapping[str, Column], out: str, total: str = "Total") -> DataFrame:
    """Aggregates by key, and over all rows under the name ``total``."""
    r = df.rollup(key).agg(*[a.alias(name) for name, a in aggregates.items()])
    return r.select(F.coalesce(key, F.lit(total)).alias(out), *aggregates)


def time_range(df: DataFrame, keys: Sequence[str], time: str, first: str, last: str) -> DataFrame:
    """By key the first and the last time."""
    return df.groupBy(*keys).agg(F.min(time).alias(first), F.max(time).alias(last))


def entries_and_exits(events: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """By key the entries and exits of the log."""
    return events.groupBy(*keys).agg(F.count_if(F.col("event_type") == ENTRY).alias("entries"), F.count_if(F.col("event_type") == EXIT).alias("exits"))


def entry_exit_rates(events: DataFrame, sizes: DataFrame, program: str = "program_id", size: str = "size") -> DataFrame:
    """By program its entries and exits over its mean roster size (``net_roster``)."""
    mean = sizes.groupBy(program).agg(F.avg(size).alias("_mean"))
    n = entries_and_exits(events, [program]).join(mean, program)
    return n.select(program, F.round(F.col("entries") / F.col("_mean"), 6).alias("entry_rate"), F.round(F.col("exits") / F.col("_mean"), 6).alias("exit_rate"))


def snapshot_depth(snapshots: DataFrame, program: str = "program_id", time: str = "snap_date") -> DataFrame:
    """By program its snapshots and the earliest one."""
    return snapshots.groupBy(program).agg(F.count("*").alias("n_snapshots"), F.min(time).alias("earliest"))


def seen_range(observations: DataFrame, snapshots: DataFrame, time: str = "snap_date", program: str = "program_id", key: str = "provider_id") -> DataFrame:
    """(program, provider, first_seen, last_seen): times of the first and last snapshot, by their order, that show a provider."""
    seen = observations.join(snapshots.select(program, time, "seq"), [program, time])
    return seen.groupBy(program, key).agg(F.min_by(time, "seq").alias("first_seen"), F.max_by(time, "seq").alias("last_seen"))


def event_sample(events: DataFrame, providers: DataFrame, snapshots: DataFrame, kind: str = ENTRY, n: int = 20, time: str = "event_date") -> DataFrame:
    """The first n events of a kind with their provider and snapshot, for checks by hand."""
    some = events.filter(F.col("event_type") == kind).orderBy(time, "event_id").limit(n)
    return some.join(providers, ["program_id", "provider_id"], "left").join(snapshots, ["program_id", "snapshot_id"], "left")


def preferred_rows(df: DataFrame, keys: Sequence[str], rank: Column, order: Sequence[str]) -> DataFrame:
    """The row of each key with the least rank, then the first by ``order``."""
    return first_per_key(df.withColumn("_rank", rank), list(keys), ["_rank", *order]).drop("_rank")


def select_providers(providers: DataFrame, equal: Mapping[str, object], hit: Column | None = None) -> DataFrame:
    """Providers whose columns equal the given values, of those that a search hits; a value of None asks for nothing."""
    ok = F.lit(True) if hit is None else hit
    for column, value in equal.items():
        ok = ok if value is None else ok & (F.col(column) == value)
    return providers.filter(ok)

"""Merges of new rows into a table: pure functions from two frames to the next one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _order(df: DataFrame, order: Sequence[str]) -> Column:
    """A total order of rows: the given columns, then a hash of the row, so that reruns agree."""
    return F.struct(*order, F.xxhash64(*[F.col(c) for c in df.columns]).alias("_hash"))


def _one(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(pick(F.struct(*rest), _order(df, order)).alias("_x")).select(*keys, "_x.*").select(*df.columns)


def last_wins(df: DataFrame, keys: Sequence[str], order: str | Sequence[str] = ()) -> DataFrame:
    """The row of each key that is last by ``order``; of rows that are equal in it the one with the greatest hash."""
    return _one(df, keys, [order] if isinstance(order, str) else order, F.max_by)


def merge_upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Incoming rows replace those of their key; of incoming rows with one key the last by ``order`` counts."""
    incoming = last_wins(incoming, keys, order)
    return existing.join(incoming.select(*keys), list(keys), "left_anti").unionByName(incoming)


def merge_insert_new(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Only rows of new keys are added, of those with one key the first by ``order``; what is there never changes."""
    return existing.unionByName(_one(incoming.join(existing.select(*keys), list(keys), "left_anti").select(*incoming.columns), keys, order, F.min_by))


def _side_by_side(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """existing and incoming rows (one a key) as structs _a and _b."""
    rest = [c for c in existing.columns if c not in keys]
    a = existing.select(*keys, F.struct(*rest).alias("_a"))
    b = incoming.select(*keys, F.struct(*rest).alias("_b"))
    return a.join(b, list(keys), "full_outer")


def merge_first_seen(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], keep: Sequence[str], frozen: Sequence[str] = (), order: Sequence[str] = ()) -> DataFrame:
    """An upsert in which columns ``keep`` stay once known and columns ``frozen`` stay as first inserted, null or not.

    Incoming rows with one key count one after the other by ``order``: the first known value of ``keep``, the first value
    of ``frozen``, the last of other columns.
    """
    at = _order(incoming, order)

    def one(c: str) -> Column:
        if c in frozen:
            return F.min_by(c, at)
        return F.min_by(c, F.when(F.col(c).isNotNull(), at)) if c in keep else F.max_by(c, at)

    both = _side_by_side(existing, incoming.groupBy(*keys).agg(*[one(c).alias(c) for c in existing.columns if c not in keys]), keys)

    def value(c: str) -> Column:
        a, b = F.col("_a")[c], F.col("_b")[c]
        if c in frozen:
            return F.when(F.col("_a").isNotNull(), a).otherwise(b)
        return F.coalesce(a, b) if c in keep else F.when(F.col("_b").isNotNull(), b).otherwise(a)

    return both.select(*keys, *[value(c).alias(c) for c in existing.columns if c not in keys]).select(*existing.columns)


def merge_verified(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], flag: str = "verified", order: Sequence[str] = ()) -> DataFrame:
    """An upsert that leaves rows alone which a person has verified, those that the same batch brings included: of incoming
    rows with one key the first verified one by ``order`` counts, else the last."""
    rest = [c for c in existing.columns if c not in keys]
    row, at = F.struct(*rest), _order(incoming, order)
    one = incoming.groupBy(*keys).agg(F.coalesce(F.min_by(row, F.when(F.col(flag), at)), F.max_by(row, at)).alias("_x")).select(*keys, "_x.*")
    both = _side_by_side(existing, one, keys)
    stays = F.col("_b").isNull() | F.coalesce(F.col("_a")[flag], F.lit(False))
    return both.select(*keys, *[F.when(stays, F.col("_a")[c]).otherwise(F.col("_b")[c]).alias(c) for c in rest]).select(*existing.columns)


def ledger_merge(existing: DataFrame, candidates: DataFrame, ordinal: str, pair: Sequence[str] = ("item", "jurisdiction")) -> DataFrame:
    """The ledger with candidates whose pair no row of it covers; of candidates with one pair the first. Human edits stay."""
    first = candidates.withColumn("_r", F.row_number().over(Window.partitionBy(*pair).orderBy(ordinal))).filter("_r = 1").drop("_r", ordinal)
    return merge_insert_new(existing, first, pair)


def stamp_provenance(rows: DataFrame, snaps: DataFrame, key: str, stamps: Sequence[str], last: str = "last_seen_snapshot_id", first: str = "first_seen_snapshot_id") -> DataFrame:
    """rows with their snapshot's provenance and last seen; first seen only where it was not known."""
    own = snaps.select(F.col("snapshot_id").alias(key), *stamps)
    out = rows.drop(*stamps).join(own, key)
    return out.withColumn(last, F.col(key)).withColumn(first, F.coalesce(first, key))


def guarded_write(rows: DataFrame, parent: DataFrame, key: str, parent_key: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose parent exists, rows whose parent is missing); a null reference is no reference and is good."""
    known = parent.select(F.col(parent_key).alias(key)).distinct()
    missing = rows.filter(F.col(key).isNotNull()).join(known, key, "left_anti")
    good = rows.join(known, key, "left_semi").unionByName(rows.filter(F.col(key).isNull()))
    return good, missing.select(*rows.columns)


def apply_signals(programs: DataFrame, signals: DataFrame, least: float = 0.5) -> DataFrame:
    """programs with the proposals of changing signals of enough confidence; what a signal does not propose stays.

    Of several such signals of a program the most confident one counts.
    """
    strong = signals.filter(F.col("is_change") & (F.col("confidence") >= least)).select("program_id", "confidence", "proposed_status", "proposed_sunset", F.col("source_url").alias("_url"))
    strong = last_wins(strong, ["program_id"], "confidence").drop("confidence")
    return (
        programs.join(strong, "program_id", "left").withColumn("program_status", F.coalesce("proposed_status", "program_status")).withColumn("sunset_date", F.coalesce("proposed_sunset", "sunset_date"))
        .withColumn("source_url", F.coalesce("_url", "source_url")).select(*programs.columns)
    )

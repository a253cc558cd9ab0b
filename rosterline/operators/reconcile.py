"""Reconciliation with outside inventories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frame_reconcile(ours: DataFrame, theirs: DataFrame, keys: Sequence[str], scope: str, enumerated: DataFrame) -> DataFrame:
    """(keys, direction): theirs that we lack, and ours that they lack where their source enumerates that type."""
    keys = list(keys)
    missing = theirs.join(ours.select(*keys).distinct(), keys, "left_anti").select(*keys, F.lit("theirs_not_ours").alias("direction"))
    in_scope = ours.join(enumerated.select(scope).distinct(), scope, "left_semi")
    extra = in_scope.join(theirs.select(*keys).distinct(), keys, "left_anti").select(*keys, F.lit("ours_not_theirs").alias("direction"))
    return missing.unionByName(extra).withColumn("classification", F.lit("unresolved"))


def split_inventory(rows: DataFrame, type_col: str, bucket_col: str, implemented: Sequence[str]) -> DataFrame:
    """rows with their label: unmapped without a known type, implemented by bucket, else informational."""
    return rows.withColumn("label", F.when(F.col(type_col).isNull(), "unmapped").when(F.col(bucket_col).isin(list(implemented)), "implemented").otherwise("informational"))


def coverage_report(parsed: DataFrame, stated: DataFrame, key: str, documented_zero: DataFrame) -> DataFrame:
    """(key, n, stated, coverage, label): full, partial, no_source_total, or zero_documented."""
    counts = parsed.groupBy(key).agg(F.count("*").alias("n"))
    out = stated.join(counts, key, "left").join(documented_zero.select(key, F.lit(True).alias("_zero")).distinct(), key, "left")
    n = F.coalesce("n", F.lit(0))
    label = F.when((n == 0) & F.col("_zero"), "zero_documented").when(F.col("stated").isNull(), "no_source_total").when(n >= F.col("stated"), "full").otherwise("partial")
    return out.select(key, n.alias("n"), "stated", F.round(n / F.nullif("stated", F.lit(0)), 6).alias("coverage"), label.alias("label"))


def divergence(ours: DataFrame, published: DataFrame, key: str, limit: float = 0.1) -> DataFrame:
    """(key, ours, published, divergence, flagged): relative difference, flagged above the limit."""
    d = (F.col("ours") - F.col("published")) / F.nullif("published", F.lit(0))
    return ours.join(published, key).select(key, "ours", "published", F.round(d, 6).alias("divergence"), F.coalesce(F.abs(d) > limit, F.lit(False)).alias("flagged"))


def fallback_union(primary: DataFrame, secondary: DataFrame, key: str) -> DataFrame:
    """The primary's rows, and the secondary's for keys that the primary does not have."""
    return primary.unionByName(secondary.join(primary.select(key).distinct(), key, "left_anti").select(*primary.columns))


def ledger_state(ledger: DataFrame) -> DataFrame:
    return ledger.agg(F.count_if("resolved").alias("resolved"), F.count_if(~F.col("resolved")).alias("unresolved"), F.count_distinct("item").alias("items"))

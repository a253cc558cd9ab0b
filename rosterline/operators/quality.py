"""Checks: rules on rows, guards on captures, references, floors, drift, and the audit that joins them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.schemas import Table
from .sizes import broadcast_if_small


def rule_errors(rules: dict[str, Column]) -> Column:
    """Messages of the rules that a row breaks. A rule is a condition that must not be false; null passes."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(True)), F.lit(message)) for message, ok in rules.items()]))


def table_rules(table: Table, columns: Sequence[str]) -> dict[str, Column]:
    """Rules of a declared table, by message, for the columns that are there."""
    here, types = set(columns), {f.name: f.dataType.simpleString() for f in table.schema}
    out: dict[str, Column] = {}
    for c in table.required:
        if c in here:
            out[f"{c}: required"] = F.col(c).isNotNull() & ((F.trim(F.col(c)) != "") if types[c] == "string" else F.lit(True))
    out |= {f"{c}: pattern": F.col(c).rlike(p) for c, p in table.patterns.items() if c in here}
    out |= {f"{c}: value": F.col(c).isin(list(v)) for c, v in table.values.items() if c in here}
    return out | {f"{c}: range": F.col(c).between(*r) for c, r in table.ranges.items() if c in here}


def validate(df: DataFrame, rules: dict[str, Column], strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with ``errors``). Strict: reading the good rows raises on the first bad one."""
    marked = df.withColumn("errors", rule_errors(rules))
    if strict:
        checked = marked.filter(F.when(F.size("errors") > 0, F.raise_error(F.concat_ws("; ", "errors")).cast("boolean")).otherwise(True))
        return checked.drop("errors"), marked.limit(0)
    return marked.filter(F.size("errors") == 0).drop("errors"), marked.filter(F.size("errors") > 0)


def count_guard(df: DataFrame, key: str, least: int | None = None, ceiling: int | None = None) -> DataFrame:
    """(key, n_rows, verdict) of each capture: too_few below ``least``, truncated at ``ceiling`` or above, else ok."""
    n = F.col("n_rows")
    verdict = F.when(n < (least or 0), "too_few").when(n >= ceiling if ceiling else F.lit(False), "truncated").otherwise("ok")
    return df.groupBy(key).agg(F.count("*").alias("n_rows")).withColumn("verdict", verdict)


def total_guard(parsed: DataFrame, stated: DataFrame, key: str) -> DataFrame:
    """(key, n_rows, stated, verdict): parsed rows against the stated total; unknown where none is stated."""
    counts = parsed.groupBy(key).agg(F.count("*").alias("n_rows"))
    out = stated.select(key, "stated").join(counts, key, "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    return out.withColumn("verdict", F.when(F.col("stated").isNull(), "unknown").when(F.col("stated") == F.col("n_rows"), "ok").otherwise("mismatch"))


def structure_guard(df: DataFrame, key: str, text: str, required: dict[str, str]) -> DataFrame:
    """(key, missing): names of the required patterns that a page does not hold."""
    return df.select(key, F.array_compact(F.array(*[F.when(~F.col(text).rlike(p), F.lit(n)) for n, p in required.items()])).alias("missing"))


def roster_captures(captures: DataFrame, sources: DataFrame, program: str = "program_id", url: str = "source_url") -> DataFrame:
    """Captures of a program's canonical address; all of them if it has none of those but one address only."""
    marked = captures.join(sources.select(program, F.col("canonical_url")), program, "left")
    facts = marked.groupBy(program).agg(F.max((F.col(url) == F.col("canonical_url")).cast("int")).alias("_hit"), F.min(url).alias("_lo"), F.max(url).alias("_hi"))
    keep = F.when(F.coalesce(F.col("_hit"), F.lit(0)) == 1, F.col(url) == F.col("canonical_url")).otherwise(F.col("_lo") == F.col("_hi"))
    return marked.join(facts, program).filter(keep).select(*captures.columns)


def distinct_urls(captures: DataFrame, program: str = "program_id", url: str = "source_url") -> DataFrame:
    """(program, url): the different addresses of each program's captures."""
    return captures.select(program, url).distinct()


def before_first_own(captures: DataFrame, own: DataFrame, key: str, time: str) -> DataFrame:
    """Captures strictly before the key's first own one; all where it has none."""
    first = own.groupBy(key).agg(F.min(time).alias("_first"))
    return captures.join(first, key, "left").filter(F.col("_first").isNull() | (F.col(time) < F.col("_first"))).drop("_first")


def capture_range(captures: DataFrame, time: str, start: str, end: str, n: int, tie: str) -> DataFrame:
    """The first n captures of a range of dates."""
    return captures.filter(F.col(time).between(start, end)).orderBy(time, tie).limit(n)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows whose reference is not null and has no parent."""
    return child.filter(F.col(child_key).isNotNull()).join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti").select(*child.columns)


def childless(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    return parent.join(child.select(F.col(child_key).alias(parent_key)), parent_key, "left_anti").select(*parent.columns)


def error_summary(errors: DataFrame, samples: int = 10) -> DataFrame:
    """(check, n, samples, more): errors by check with their first messages in order.

    Messages are ranked in 64 parts of their hash first, so no task holds all messages of one check.
    """
    part = F.pmod(F.xxhash64("message"), F.lit(64))
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("message", "key"))
    few = errors.withColumn("_p", part).withColumn("_r", rank("check", "_p")).filter(F.col("_r") <= samples).withColumn("_r", rank("check")).filter(F.col("_r") <= samples)
    shown = few.groupBy("check").agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", "message"))), lambda x: x.message).alias("samples"))
    return errors.groupBy("check").agg(F.count("*").alias("n")).join(shown, "check").withColumn("more", F.col("n") - F.size("samples"))


def errors_of(df: DataFrame, check: str, key: str, message: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.col(key).cast("string").alias("key"), message.alias("message"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def undocumented_zero(programs: DataFrame, providers: DataFrame, documented: DataFrame, key: str = "program_id") -> DataFrame:
    """Programs without providers that are not in the documented list."""
    return childless(programs, providers, key, key).join(documented.select(key), key, "left_anti")


def floor_check(counts: DataFrame, floors: DataFrame, key: str, n: str = "n") -> DataFrame:
    """Keys below their floor; a key without rows counts 0."""
    return floors.join(counts, key, "left").withColumn(n, F.coalesce(n, F.lit(0))).filter(F.col(n) < F.col("floor"))


def set_coverage(documented: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """(key, problem): documented but unknown, known but not documented."""
    a, b = documented.select(key), known.select(key)
    return a.subtract(b).withColumn("problem", F.lit("unknown")).unionByName(b.subtract(a).withColumn("problem", F.lit("undocumented")))


LEAVES, FAN = 65_536, 256


def release_fingerprint(df: DataFrame, keys: Sequence[str] | None = None, leaves: int = LEAVES) -> DataFrame:
    """(leaf, n, s1, s2, s3, s4): how many rows have a key in each leaf, and sums of two 64-bit hashes of them, as 32-bit halves.

    Equal multisets of rows have equal fingerprints; repeated rows count. Nulls are told apart from other values by
    position. It is one aggregate with partial sums, at most ``leaves`` rows, and can be kept beside a release, so that a
    later one is compared without reading the old rows.
    """
    seen = [F.col(c) for c in df.columns]
    nulls = [F.col(c).isNull() for c in df.columns]
    one, two = F.xxhash64(*seen, *nulls), F.xxhash64(F.lit("again"), *nulls, *seen)
    low, high = lambda h: h.bitwiseAND(F.lit(0xFFFFFFFF)), lambda h: F.shiftright(h, 32)
    rows = df.select(_leaf(df, keys, leaves).alias("leaf"), one.alias("one"), two.alias("two"))
    return rows.groupBy("leaf").agg(
        F.count("*").alias("n"), F.sum(low(F.col("one"))).alias("s1"), F.sum(high(F.col("one"))).alias("s2"), F.sum(low(F.col("two"))).alias("s3"), F.sum(high(F.col("two"))).alias("s4"),
    )


def _leaf(df: DataFrame, keys: Sequence[str] | None, leaves: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in keys or df.columns]), F.lit(leaves)).cast("int")


def _differ(a: DataFrame, b: DataFrame, by: str) -> DataFrame:
    sums = ["n", "s1", "s2", "s3", "s4"]
    both = a.select(by, *[F.col(c).alias(f"a_{c}") for c in sums]).join(b.select(by, *[F.col(c).alias(f"b_{c}") for c in sums]), by, "full_outer")
    same = [F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in sums]
    return both.filter(~reduce(lambda x, y: x & y, same)).select(by)


def unequal_leaves(a: DataFrame, b: DataFrame) -> DataFrame:
    """The leaves in which two fingerprints differ, found from the top: sums of 256 leaves first, leaves only below those that differ."""
    top = F.floor(F.col("leaf") / FAN).alias("top")
    up = lambda f: f.groupBy(top).agg(*[F.sum(c).alias(c) for c in ("n", "s1", "s2", "s3", "s4")])
    open_ = _differ(up(a), up(b), "top")
    under = lambda f: f.withColumn("top", top).join(broadcast_if_small(open_), "top", "left_semi").drop("top")
    return _differ(under(a), under(b), "leaf")


def release_drift(a: DataFrame, b: DataFrame, keys: Sequence[str] | None = None, leaves: int = LEAVES) -> DataFrame:
    """Rows that only one of two builds has, with the side; row counts matter.

    Fingerprints of both are compared first; only rows in leaves that differ are shuffled and counted, those of ``a`` with
    a plus, those of ``b`` with a minus. With ``keys`` a row that changed is in one leaf on both sides. Both must have the
    same columns; values that hash alike and differ by type only are cast to the first's.
    """
    b = b.select(*[F.col(f.name).cast(f.dataType) for f in a.schema])
    open_ = broadcast_if_small(unequal_leaves(release_fingerprint(a, keys, leaves), release_fingerprint(b, keys, leaves)))
    part = lambda df, sign: df.withColumn("leaf", _leaf(df, keys, leaves)).join(open_, "leaf", "left_semi").drop("leaf").withColumn("_sign", F.lit(sign))
    net = part(a, 1).unionByName(part(b, -1)).groupBy(*a.columns).agg(F.sum("_sign").alias("_net")).filter("_net <> 0")
    side = F.when(F.col("_net") > 0, "only_first").otherwise("only_second")
    return net.withColumn("side", side).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.abs("_net")))).drop("_net", "_copy")


def blob_integrity(manifest: DataFrame, blobs: DataFrame) -> DataFrame:
    """(path, problem): manifest paths without a file, files with another hash than the manifest says."""
    both = manifest.select("path", F.col("sha256").alias("_want")).join(blobs.select("path", F.col("sha256").alias("_have")), "path", "left")
    problem = F.when(F.col("_have").isNull(), "missing").when(F.col("_have") != F.col("_want"), "hash_mismatch")
    return both.withColumn("problem", problem).filter("problem is not null").select("path", "problem")


def reference_errors(df: DataFrame, key: str, references: Mapping[str, str], parent: DataFrame, parent_key: str) -> DataFrame:
    """(check, key, message) of references to one parent that are null (``<check>_null``) or have no row there, in one pass over df.

    references: column by check.
    """
    ids = parent.select(F.col(parent_key).alias("_id")).filter("_id is not null").distinct()
    found = []
    for check, col in references.items():
        df = df.join(ids.select(F.col("_id").alias(f"_{check}")), F.col(col) == F.col(f"_{check}"), "left")
        told = lambda name, message: F.struct(F.lit(name).alias("check"), message.alias("message"))
        none = told(check, F.concat(F.lit(f"{col} "), F.col(col).cast("string"), F.lit(" has no row")))
        found.append(F.when(F.col(col).isNull(), told(f"{check}_null", F.lit(f"{col} is null"))).when(F.col(f"_{check}").isNull(), none))
    return df.select(F.col(key).cast("string").alias("key"), F.explode(F.array_compact(F.array(*found))).alias("_e")).select("_e.check", "key", "_e.message")


def provenance_audit(providers: DataFrame, events: DataFrame, snaps: DataFrame, programs: DataFrame, aliases: DataFrame, blobs: DataFrame | None = None) -> DataFrame:
    """(check, key, message) of all breaches of provenance; an empty result passes. Providers' and events' references are checked
    in one pass each, so a rebuild that derives them is not computed for every check."""
    found = [
        reference_errors(providers, "provider_id", {"provider_first_seen": "first_seen_snapshot_id", "provider_last_seen": "last_seen_snapshot_id"}, snaps, "snapshot_id"),
        reference_errors(events, "event_id", {"event_snapshot": "source_snapshot_id"}, snaps, "snapshot_id"),
        errors_of(snaps.filter("source_url is null"), "snapshot_url_null", "snapshot_id", F.lit("source_url is null")),
        errors_of(childless(programs, snaps, "program_id", "program_id"), "program_without_snapshot", "program_id", F.lit("no snapshot")),
        errors_of(orphans(aliases, providers, "provider_id", "provider_id"), "alias_provider", "alias_name", F.concat(F.lit("provider_id "), F.col("provider_id").cast("string"), F.lit(" has no row"))),
    ]
    if blobs is not None:
        found.append(errors_of(blobs, "blob_integrity", "path", F.col("problem")))
    return union_all(found)

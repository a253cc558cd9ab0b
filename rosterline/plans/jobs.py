"""Whole jobs: rebuild, incremental run, backfill, completeness, status resolution, analyst bundle."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geo, signals
from ..operators import diff, merge, quality, reconcile, status
from ..operators.sizes import broadcast_if_small
from ..sources import files, nested, pages
from ..sources.scratch import new_path


@dataclass
class Rebuild:
    events: DataFrame
    providers: DataFrame
    snapshots: DataFrame
    errors: DataFrame


def number_snapshots(manifest: DataFrame, skip_empty: DataFrame | None = None) -> DataFrame:
    """Captures with their order in the program; with ``skip_empty`` (observations) those without rows are left out."""
    rows = manifest if skip_empty is None else manifest.join(skip_empty.select("program_id", "retrieved_at").distinct(), ["program_id", "retrieved_at"], "left_semi")
    return rows.withColumn("seq", F.row_number().over(Window.partitionBy("program_id").orderBy("retrieved_at", "snapshot_id")))


def rebuild(manifest: DataFrame, observations: DataFrame, sources: DataFrame, programs: DataFrame, skip_empty: bool = False) -> Rebuild:
    """The full event log, the entities and the audit from a manifest and parsed rosters.

    manifest: program_id, snapshot_id, source_url, retrieved_at, content_sha256. observations: program_id, retrieved_at,
    provider_id, row_no, status. Captures of other addresses and those with the bytes of the one before are left out.
    """
    kept = quality.roster_captures(manifest, sources)
    kept = diff.consecutive_dedup(kept, "program_id", ["retrieved_at", "snapshot_id"], "content_sha256")
    snaps = number_snapshots(kept, observations if skip_empty else None)
    rows = diff.last_in_roster(observations, ("program_id", "retrieved_at", "provider_id"))
    events = diff.with_event_id(diff.diff_chain(rows, snaps.select("program_id", "retrieved_at", "snapshot_id", "seq"), "retrieved_at"))
    events = events.withColumn("event_date", F.to_date("retrieved_at")).withColumn("source_snapshot_id", F.col("snapshot_id"))
    seen = rows.join(snaps.select("program_id", "retrieved_at", "snapshot_id", "seq"), ["program_id", "retrieved_at"])
    order = F.col("seq")
    providers = seen.groupBy("program_id", "provider_id").agg(
        F.min_by("snapshot_id", order).alias("first_seen_snapshot_id"), F.max_by("snapshot_id", order).alias("last_seen_snapshot_id"), F.max_by("status", order).alias("current_status")
    )
    providers = status.recompute_status(providers, events, ["program_id", "provider_id"])
    aliases = providers.select("provider_id", F.lit("").alias("alias_name")).limit(0)
    errors = quality.provenance_audit(providers, events, kept, programs, aliases)
    return Rebuild(events, providers, kept, errors)


@dataclass
class FileRebuild:
    rebuilt: Rebuild
    observations: DataFrame
    dispositions: DataFrame


def rebuild_from_files(
    spark: SparkSession, manifest_path: str, blob_root: str, parsers: Mapping[str, Callable[[bytes], Iterable[dict]]], sources: DataFrame, programs: DataFrame, partial: Sequence[str] = (),
) -> FileRebuild:
    """The event log, entities and audit from a manifest file and the raw captures that it registers; nothing is fetched.

    Each blob's bytes are hashed and parsed in one pass beside its manifest row; the parser of a program gives dicts with
    provider_id and status. The rows are written once, and two things are read from them: observations, numbered as the
    parser gave them, and the disposition of each capture (program_id, retrieved_at, snapshot_id, n_rows, error, is_partial): ``ingested``,
    ``missing``, ``hash_mismatch``, ``empty`` or ``parse_error``. Captures that aren't ingested have no place in the chain, so
    nobody leaves a roster because a file is broken.

    Blobs go to the manifest by path: the manifest is sent to them where it is small, and bytes that several captures share
    are read for each.
    """
    manifest = files.read_manifest(spark, manifest_path).withColumn("capture", F.concat_ws("|", "program_id", F.col("retrieved_at").cast("string"), "snapshot_id"))
    blobs = files.read_blobs(spark, blob_root).select(F.col("path").alias("storage_path"), "content", F.col("sha256").alias("_have"))
    held = blobs.join(broadcast_if_small(manifest.select("storage_path", "program_id", "capture", "content_sha256")), "storage_path")
    wrong = F.when(F.col("_have") != F.col("content_sha256"), "hash_mismatch")
    parsed = pages.parse_captures(held.withColumn("problem", wrong), parsers, "provider_id string, status string", key="capture", partial=partial, problem="problem")
    path = new_path(spark, "parsed")
    parsed.write.parquet(path)
    parsed = spark.read.schema(parsed.schema).parquet(path)

    own = parsed.groupBy("capture").agg(F.count("row_no").alias("n_rows"), F.max("error").alias("error"), F.bool_or("is_partial").alias("is_partial"))
    label = F.when(F.col("n_rows").isNull(), "missing").when(F.col("error") == "hash_mismatch", "hash_mismatch").when(F.col("error") == "no rows", "empty").when(F.col("error").isNotNull(), "parse_error").otherwise("ingested")
    marked = manifest.join(own, "capture", "left").withColumn("disposition", label)
    rows = parsed.filter("error is null").join(marked.filter("disposition = 'ingested'").select("capture", "retrieved_at"), "capture").select("program_id", "retrieved_at", "provider_id", "row_no", "status", "is_partial")
    kept = marked.filter("disposition = 'ingested'").select("program_id", "snapshot_id", "source_url", "retrieved_at", "content_sha256")
    shown = marked.select("program_id", "retrieved_at", "snapshot_id", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "error", F.coalesce("is_partial", F.lit(False)).alias("is_partial"), "disposition")
    return FileRebuild(rebuild(kept, rows, sources, programs), rows, shown)


def publish(out: Rebuild, folder: str) -> dict[str, int]:
    """Write a rebuild as a release, each table in the order of its key; an audit that is not empty stops it."""
    if not out.errors.isEmpty():
        raise ValueError("the audit of the rebuild has errors")
    tables = {"provider": out.providers, "event": out.events, "snapshot": out.snapshots}
    return files.export_tables(tables, {"provider": ["program_id", "provider_id"], "event": ["event_id"], "snapshot": ["program_id", "snapshot_id"]}, folder)


def run_summary(providers: DataFrame, events: DataFrame) -> DataFrame:
    """(program_id, providers, added, removed, changed) of a run: rows of the roster and events by kind."""
    n = providers.groupBy("program_id").agg(F.count_distinct("provider_id").alias("providers"))
    of = lambda kind, name: F.count_if(F.col("event_type") == kind).alias(name)
    e = events.groupBy("program_id").agg(of("authorized", "added"), of("disappeared_from_roster", "removed"), of("status_change", "changed"))
    return n.join(e, "program_id", "left").fillna(0, ["added", "removed", "changed"])


def incremental(previous: DataFrame, roster: DataFrame, last: DataFrame, captures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, summary) of new captures against the last rosters. Nothing is written, so it is also the preview of a run.

    last and captures: program_id, content_sha256 of the last and of the new capture. A program whose bytes are those of
    its last capture is unchanged and has no events. Of one id twice in a roster with ``row_no`` the last row counts. summary: program_id, run_status (first, updated, unchanged),
    providers, added, removed, changed.
    """
    if "row_no" in roster.columns:
        roster = diff.last_in_roster(roster, ("program_id", "provider_id"))
    state = captures.select("program_id", F.col("content_sha256").alias("_new")).join(last.select("program_id", F.col("content_sha256").alias("_old")), "program_id", "left")
    label = F.when(F.col("_old").isNull(), "first").when(F.col("_old") == F.col("_new"), "unchanged").otherwise("updated")
    state = state.select("program_id", label.alias("run_status"))
    open_ = state.filter("run_status <> 'unchanged'").select("program_id")
    events = diff.snapshot_diff(previous.join(open_, "program_id", "left_semi"), roster.join(open_, "program_id", "left_semi"))
    summary = state.join(run_summary(roster, events), "program_id", "left").fillna(0, ["providers", "added", "removed", "changed"])
    return events, summary


def dispositions(captures: DataFrame, kept: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """captures with ``disposition``: skipped (not kept), parse_error, empty (no rows counted) or ingested."""
    label = F.when(F.col("_kept").isNull(), "skipped").when(F.col("error").isNotNull(), "parse_error").when(F.col("n_rows").isNull(), "empty").otherwise("ingested")
    marked = captures.join(kept.select(*keys, F.lit(True).alias("_kept")), keys, "left").join(counts, keys, "left")
    return marked.withColumn("disposition", label).drop("_kept", "n_rows")


def disposition_counts(marked: DataFrame, program: str = "program_id") -> DataFrame:
    """(program, ingested, skipped, parse_error, empty, partial): captures by disposition; partial ones are ingested too."""
    of = lambda name: F.count_if(F.col("disposition") == name).alias(name)
    partial = F.count_if((F.col("disposition") == "ingested") & F.col("is_partial")).alias("partial")
    return marked.groupBy(program).agg(of("ingested"), of("skipped"), of("parse_error"), of("empty"), partial)


def backfill(captures: DataFrame, own: DataFrame, parsed: DataFrame, days: int = 90) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(events, snapshots, gaps, report) of historical captures before the first own one.

    captures: program_id, capture_id, captured_at, digest, error, and is_partial if parsers set it. parsed: program_id,
    capture_id, provider_id, status. own: program_id, captured_at, snapshot_id; snapshots are its rows and the captures
    that are new to it.
    """
    if "is_partial" not in captures.columns:
        captures = captures.withColumn("is_partial", F.lit(False))
    keys = ["program_id", "capture_id"]
    early = quality.before_first_own(captures, own.select("program_id", F.col("captured_at")), "program_id", "captured_at")
    kept = diff.consecutive_dedup(early, "program_id", ["captured_at", "capture_id"], "digest")
    marked = dispositions(early, kept, parsed.groupBy(*keys).agg(F.count("*").alias("n_rows")), keys)
    good = marked.filter("disposition = 'ingested'")
    snaps = good.select("program_id", F.col("capture_id").alias("snapshot_id"), "captured_at").withColumn("seq", F.row_number().over(Window.partitionBy("program_id").orderBy("captured_at", "snapshot_id")))
    rows = parsed.join(good.select(*keys, "captured_at"), keys)
    events = diff.with_event_id(diff.diff_chain(rows, snaps, "captured_at"))
    gaps = status.capture_gaps(good, "program_id", "captured_at", days).unionByName(status.bridge_gap(good, own, "program_id", "captured_at", days))
    columns = ["program_id", "captured_at", "snapshot_id"]
    known = merge.merge_insert_new(own.select(*columns), snaps.select(*columns), ["snapshot_id"], ["captured_at"])
    return events, known, gaps, disposition_counts(marked)


def completeness(ours: DataFrame, inventory: DataFrame, ledger: DataFrame, implemented: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(ledger, state): outside rows that are implemented are reconciled with ours; new gaps join the ledger after its own rows."""
    theirs = reconcile.split_inventory(inventory, "model_type", "status_bucket", implemented).filter("label = 'implemented'")
    gaps = reconcile.frame_reconcile(ours, theirs, ["jurisdiction", "model_type"], "model_type", theirs)
    candidates = gaps.select(
        F.concat_ws(" ", "direction", "model_type").alias("item"), "jurisdiction", "classification", F.lit(False).alias("resolved"), F.lit("frame_reconcile").alias("detected_by"),
        F.row_number().over(Window.partitionBy("jurisdiction").orderBy("model_type", "direction")).alias("ordinal"),
    )
    merged = merge.ledger_merge(ledger, candidates, "ordinal")
    return merged, reconcile.ledger_state(merged)


def resolve_status(programs: DataFrame, bills: DataFrame, configs: DataFrame) -> DataFrame:
    """A signal for each program from its best bill: proposed status and sunset date, confidence, evidence of up to five
    bills, the address that speaks for it, and the reason in words.

    configs: program_id, state, queries, known_bills, pending_rules, override, override_sunset, override_url. bills:
    bill_id, identifier, title, abstract, state, latest_action, action_date, classes, url. An override wins over any bill,
    with its own date and address; bills are its evidence still. A bill proposes no date.
    """
    c = configs.select("program_id", F.col("state").alias("_state"), "queries")
    found = F.exists("queries", lambda q: F.lower(F.col("title")).contains(F.lower(q)))
    known = F.coalesce(F.array_contains("_known", F.col("program_id")), F.lit(False))
    pairs = with_known(bills, configs).join(broadcast_if_small(c), (F.col("state") == F.col("_state")) & (found | known))
    pairs = pairs.withColumns({"_hit": known, "way": signals.direction(F.col("title"), F.col("abstract")), "is_enacted": signals.enacted(F.col("latest_action"), F.col("classes")), "has_failed": signals.failed(F.col("latest_action"))}).drop("_known")
    pairs = pairs.withColumn("score", signals.scored(F.col("_hit"), F.col("title"), F.col("is_enacted"), F.col("queries")))
    top = top_ranked(pairs, "program_id", [F.desc("score"), F.desc_nulls_last("action_date"), F.asc("bill_id")], 5)
    evidence = top.groupBy("program_id").agg(F.array_sort(F.collect_list(F.struct("rank", "bill_id"))).alias("e")).select("program_id", F.transform("e", lambda x: x.bill_id).alias("evidence"))
    best = top.filter("rank = 1").select("program_id", "score", "way", "is_enacted", "has_failed", "url", "identifier")
    out = programs.join(configs.select("program_id", "pending_rules", "override", "override_sunset", "override_url"), "program_id").join(best, "program_id", "left").join(evidence, "program_id", "left")
    given = F.col("override").isNotNull()
    proposed = F.coalesce("override", signals.proposed_status(F.col("score"), F.col("way"), F.col("is_enacted"), F.col("has_failed"), F.col("pending_rules")))
    confidence = F.when(given, 1.0).otherwise(F.coalesce(signals.proposal_confidence(F.col("score"), F.col("way"), F.col("is_enacted")), F.lit(0.0)))
    out = out.withColumn("proposed_status", F.when(given | F.col("score").isNotNull(), proposed)).withColumn("confidence", confidence)
    sunset = F.when(given, F.col("override_sunset"))
    way, passed = F.col("way"), F.col("is_enacted")
    why = (
        F.when(given, "set by an order, not by a bill").when(F.col("score").isNull(), "no bill found").when(F.col("score") < signals.LOW, "best bill of little relevance")
        .when((way == "negative") & passed, "ending bill enacted").when((way == "positive") & passed, F.when(F.col("pending_rules"), "founding bill enacted, its rules pending").otherwise("founding bill enacted"))
        .when((way == "positive") & ~F.col("has_failed"), "founding bill pending").when(way == "negative", "ending bill pending").otherwise("direction unclear")
    )
    reason = F.concat_ws(": ", why, F.when(given, F.col("override_url")).otherwise(F.col("identifier")))
    return out.select(
        "program_id", "program_status", "proposed_status", reason.alias("reason"), sunset.alias("proposed_sunset"), "confidence", "evidence", F.when(given, F.col("override_url")).otherwise(F.col("url")).alias("source_url"),
        signals.is_change(F.col("program_status"), F.col("proposed_status"), sunset).alias("is_change"),
    )


def with_known(bills: DataFrame, configs: DataFrame) -> DataFrame:
    """bills with ``_known``: the programs of their state that list the identifier, or a part of it, among their known bills.

    Case and spaces don't count. The parts of an identifier that have the length of a listed one are looked up in a join, so
    a bill is not held against each listed one.
    """
    flat = lambda c: F.replace(F.lower(c), F.lit(" "), F.lit(""))
    listed = configs.select(F.col("state").alias("_s"), "program_id", F.explode("known_bills").alias("_k")).select("_s", "program_id", flat(F.col("_k")).alias("_part")).filter("_part is not null").distinct()
    lengths = listed.groupBy("_s").agg(F.collect_set(F.length("_part")).alias("_lengths"))
    names = bills.select(F.col("state").alias("_s"), flat(F.col("identifier")).alias("_flat")).distinct().join(broadcast_if_small(lengths), "_s")
    parts = F.flatten(F.transform("_lengths", lambda n: F.when(n > F.length("_flat"), F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.length("_flat") - n + 1), lambda i: F.substring(F.col("_flat"), i, n)))))
    held = names.select("_s", "_flat", F.explode(F.array_distinct(parts)).alias("_part")).join(listed, ["_s", "_part"]).groupBy("_s", "_flat").agg(F.collect_set("program_id").alias("_known"))
    return bills.withColumns({"_s": F.col("state"), "_flat": flat(F.col("identifier"))}).join(held, ["_s", "_flat"], "left").drop("_s", "_flat")


def top_ranked(df: DataFrame, key: str, order: list, n: int) -> DataFrame:
    """The first n rows of each key by ``order``, with their ``rank``."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("rank") <= n)


@dataclass
class Bundle:
    programs: DataFrame
    totals: DataFrame
    places: DataFrame
    roster_sizes: DataFrame
    undocumented: DataFrame
    map: DataFrame | None = None


def map_paths(shapes: DataFrame, names: DataFrame, col: str = "geojson", skip: Sequence[str] = ()) -> DataFrame:
    """(jurisdiction, path) of map JSON, projected and fitted to the viewport; names: shape, jurisdiction. Shapes without a jurisdiction
    are an error of the names and raise when the map is read."""
    points = nested.explode_geojson(shapes, col, skip).join(broadcast_if_small(names), "shape", "left")
    known = F.coalesce("jurisdiction", F.raise_error(F.concat(F.lit("no jurisdiction for "), "shape")).cast("string"))
    x, y = geo.albers(F.col("lon"), F.col("lat"))
    ring = F.concat_ws("|", "shape", F.format_string("%09d", "ring"))
    return geo.ring_paths(geo.fit_viewport(points.select(known.alias("jurisdiction"), ring.alias("ring"), "pos", x.alias("x"), y.alias("y"))), "jurisdiction")


def bundle(
    programs: DataFrame, providers: DataFrame, events: DataFrame, documented_zero: DataFrame, folder: str | None = None, shapes: DataFrame | None = None, names: DataFrame | None = None, skip: Sequence[str] = (),
) -> Bundle:
    """The analyst's tables: programs with counts, totals, programs and providers by jurisdiction, running roster sizes,
    undocumented zeros, and with ``shapes`` the map (see ``map_paths``). With ``folder`` they are written as JSON files, roster
    sizes inside their programs; a program without providers that is not documented stops that."""
    counts = providers.groupBy("program_id").agg(F.count("*").alias("providers"), F.count_if(F.col("current_status") == "active").alias("active"))
    rows = programs.join(counts, "program_id", "left").fillna(0, ["providers", "active"]).withColumn("has_providers", F.col("providers") > 0)
    totals = rows.agg(F.count("*").alias("programs"), F.count_distinct("jurisdiction").alias("jurisdictions"), F.coalesce(F.sum("providers"), F.lit(0)).alias("providers"), F.coalesce(F.sum("active"), F.lit(0)).alias("active"))
    places = rows.groupBy("jurisdiction").agg(
        F.array_sort(F.collect_list("program_id")).alias("program_ids"), F.sum("providers").alias("providers"), F.bool_and(F.col("providers") == 0).alias("all_zero")
    )
    out = Bundle(rows, totals, places, status.net_roster(events), quality.undocumented_zero(programs, providers, documented_zero), map_paths(shapes, names, skip=skip) if shapes is not None else None)
    if folder is not None:
        if not out.undocumented.isEmpty():
            raise ValueError("programs without providers are not documented")
        tables = {"programs": rows, "totals": totals, "places": places, "roster_sizes": out.roster_sizes} | ({"map": out.map} if out.map is not None else {})
        files.write_bundle(tables, folder, {"roster_sizes": ("programs", "program_id")})
    return out

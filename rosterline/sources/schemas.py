"""Tables of a registry, declared once: columns, keys, parents and the rules of their values."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

PROVENANCE = "source_url string, retrieved_at timestamp, scraper_version string"
#: The closed vocabularies.
VOCABULARY = {
    "provider_type": ("entity", "individual"), "current_status": ("active", "suspended", "revoked", "exited", "unknown"),
    "event_type": ("authorized", "status_change", "disciplined", "reinstated", "disappeared_from_roster"), "media_type": ("html", "pdf", "json", "xlsx"),
}


@dataclass(frozen=True)
class Table:
    columns: str
    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    parents: dict[str, str] = field(default_factory=dict)  # column -> parent table
    patterns: dict[str, str] = field(default_factory=dict)
    values: dict[str, tuple[str, ...]] = field(default_factory=dict)
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)


_STAMP = ("source_url", "retrieved_at", "scraper_version")
_URL = {"source_url": "^https?://"}
TABLES = {
    "program": Table(
        f"program_id string, jurisdiction string, program_name string, program_type string, regulator string, regulator_url string, authorizing_rule string, launch_date date, program_status string, sunset_date date, allows_nonlawyer_ownership boolean, allows_upl_waiver boolean, allows_software_provider boolean, {PROVENANCE}",
        ("program_id",), ("program_id", "jurisdiction", "program_name", *_STAMP), patterns={"jurisdiction": "^[A-Z]{2}$", **_URL},
    ),
    "source_snapshot": Table(
        f"snapshot_id string, program_id string, content_sha256 string, storage_path string, media_type string, {PROVENANCE}",
        ("snapshot_id",), ("snapshot_id", "program_id", "content_sha256", *_STAMP), {"program_id": "program"}, {"content_sha256": "^[0-9a-f]{64}$", **_URL}, {"media_type": VOCABULARY["media_type"]},
    ),
    "provider": Table(
        f"provider_id string, program_id string, provider_type string, legal_name string, normalized_name string, jurisdiction string, authorization_date date, current_status string, practice_areas_raw array<string>, practice_areas_list array<string>, ownership_structure string, uses_technology boolean, uses_ai boolean, website string, first_seen_snapshot_id string, last_seen_snapshot_id string, {PROVENANCE}",
        ("provider_id",), ("provider_id", "program_id", "legal_name", *_STAMP), {"program_id": "program", "first_seen_snapshot_id": "source_snapshot", "last_seen_snapshot_id": "source_snapshot"},
        {"jurisdiction": "^[A-Z]{2}$", **_URL}, {"provider_type": VOCABULARY["provider_type"], "current_status": VOCABULARY["current_status"]},
    ),
    "provider_status_event": Table(
        f"event_id string, provider_id string, event_date date, event_type string, new_status string, detail string, source_snapshot_id string, {PROVENANCE}",
        ("event_id",), ("event_id", "provider_id", "event_date", "event_type", "new_status", *_STAMP), {"source_snapshot_id": "source_snapshot"}, _URL, {"event_type": VOCABULARY["event_type"], "new_status": VOCABULARY["current_status"]},
    ),
    "provider_alias": Table(f"provider_id string, alias_name string, alias_source string, {PROVENANCE}", ("provider_id", "alias_name"), ("provider_id", "alias_name", *_STAMP), {"provider_id": "provider"}),
    "crosswalk": Table(
        "provider_id string, cl_docket_id bigint, cl_party_id bigint, match_score double, match_method string, verified boolean, reviewer string, reviewed_at timestamp",
        ("provider_id", "cl_docket_id"), ("provider_id", "cl_docket_id", "match_score", "match_method"), {"provider_id": "provider"}, ranges={"match_score": (0.0, 1.0)},
    ),
}

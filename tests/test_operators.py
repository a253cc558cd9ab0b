"""Operators on small literal tables."""

import datetime as dt
import tracemalloc

import pytest
from pyspark.sql import functions as F

from rosterline.functions import geo, names, parse, signals
from rosterline.operators import diff, match, merge, quality, reconcile, status
from rosterline.plans import documents, jobs
from rosterline.sources import files, nested, pages
from rosterline.sources.schemas import TABLES


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("x")).first()["x"]


def ts(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


@pytest.mark.parametrize("raw, want", [
    ("The Legal Solutions, LLC", "legal solutions"), ("Smith & Jones P.C.", "smith and jones"), ("Ávila Law Group PLLC", "avila law group"), ("  the  Co ", "the"), ("größe Inc", "große"), ("A\u0301vila Law", "avila law"), ("Nguyễn Legal", "nguyen legal"), ("Nguye\u0302\u0303n Legal", "nguyen legal"), ("ÅNGSTRÖM \u212b", "angstrom a"), ("한 Law", "\u1112\u1161\u11ab law"), ("가", "\u1100\u1161"), ("Coco Inco", "coco inco"),
])
def test_normal_names(spark, raw, want):
    assert one(spark, raw, names.normalize_name) == want


def test_marks_and_plain_letters_have_one_length():
    assert len(names.MARKED) == len(names.PLAIN)


@pytest.mark.parametrize("raw, want", [("Utah (through its Sandbox)", "UT"), ("Washington, D.C.", "DC"), ("United Kingdom", None)])
def test_places(spark, raw, want):
    assert parse.place_code(spark.createDataFrame([(raw,)], "p string"), "p").first()["code"] == want


@pytest.mark.parametrize("title, want", [("Repeal the pilot", "neutral"), ("An act to abolish", "negative"), ("urban parks", "negative"), ("Licensing", "positive"), ("Budget", "unknown")])
def test_directions(spark, title, want):
    assert one(spark, title, signals.direction) == want


def test_aliases_bullets_and_links(spark):
    assert one(spark, "A LLC (DBA Bee Law) (Formerly, Cee)", names.alias_names) == ["Bee Law", "Cee"]
    cell = one(spark, "March 5, 2021\n• family\n law\n•housing", parse.bullet_cell)
    assert cell["date"] == dt.date(2021, 3, 5) and cell["items"] == ["family law", "housing"]
    assert one(spark, "soon", parse.bullet_cell)["items"] == []
    assert one(spark, '<a href="/x"><a href="https://own.gov/a"><a href="http://b.org">', lambda c: parse.first_external_link(c, "own.gov")) == "http://b.org"


def events_of(rows):
    return sorted((r["provider_id"], r["seq"], r["event_type"], r["new_status"], r["detail"]) for r in rows)


def roster(spark, rows):
    """(snapshot day, provider, status)"""
    return spark.createDataFrame([("p", dt.date(2024, 1, d), i, s) for d, i, s in rows], "program_id string, snap_date date, provider_id string, status string")


def snaps(spark, days):
    return spark.createDataFrame([("p", dt.date(2024, 1, d), f"s{d}", n) for n, d in enumerate(days, 1)], "program_id string, snap_date date, snapshot_id string, seq int")


def test_three_events_between_two_rosters(spark):
    obs = roster(spark, [(1, "B", "active"), (1, "C", "active"), (2, "A", "active"), (2, "C", "suspended")])
    got = diff.snapshot_diff(obs.filter("snap_date = '2024-01-01'"), obs.filter("snap_date = '2024-01-02'")).collect()
    assert sorted((r["provider_id"], r["event_type"], r["new_status"], r["detail"]) for r in got) == [
        ("A", "authorized", "active", None), ("B", "disappeared_from_roster", "exited", None), ("C", "status_change", "suspended", "active → suspended"),
    ]


def test_chains_with_empty_rosters_and_returns(spark):
    obs = roster(spark, [(1, "A", "active"), (3, "A", "active"), (3, "B", "active"), (4, "A", "suspended")])
    got = events_of(diff.diff_chain(obs, snaps(spark, [1, 2, 3, 4])).collect())
    assert got == [
        ("A", 1, "authorized", "active", None), ("A", 2, "disappeared_from_roster", "exited", None), ("A", 3, "authorized", "active", None),
        ("A", 4, "status_change", "suspended", "active → suspended"), ("B", 3, "authorized", "active", None), ("B", 4, "disappeared_from_roster", "exited", None),
    ]
    calm = diff.grace_window(diff.diff_chain(obs, snaps(spark, [1, 2, 3, 4])), 1).collect()
    assert [e[1:3] for e in events_of(calm) if e[0] == "A"] == [(1, "authorized"), (4, "status_change")]
    spells = diff.provider_spells(obs, snaps(spark, [1, 2, 3, 4])).collect()
    assert sorted((s["provider_id"], s["n_snapshots"]) for s in spells) == [("A", 1), ("A", 2), ("B", 1)]


def test_content_that_returns_is_kept(spark):
    c = spark.createDataFrame([("p", 1, "a"), ("p", 2, "a"), ("p", 3, "b"), ("p", 4, "a"), ("q", 1, "a")], "program_id string, t int, sha string")
    assert sorted((r["program_id"], r["t"]) for r in diff.consecutive_dedup(c, "program_id", ["t"], "sha").collect()) == [("p", 1), ("p", 3), ("p", 4), ("q", 1)]


def test_last_row_of_a_roster_wins(spark):
    r = spark.createDataFrame([("p", "A", 1, "active"), ("p", "A", 2, "revoked")], "program_id string, provider_id string, row_no int, status string")
    assert [x["status"] for x in diff.last_in_roster(r).collect()] == ["revoked"]


def test_merges(spark):
    old = spark.createDataFrame([(1, "a", ["x"], True), (2, None, None, False)], "k int, first string, arr array<string>, verified boolean")
    new = spark.createDataFrame([(1, "b", ["y"], False), (2, "b", ["y"], False), (3, "c", ["z"], False)], "k int, first string, arr array<string>, verified boolean")
    rows = lambda df: {r["k"]: tuple(r)[1:] for r in df.collect()}
    assert rows(merge.merge_upsert(old, new, ["k"])) == rows(new)
    assert rows(merge.merge_insert_new(old, new, ["k"])) == {**rows(old), 3: rows(new)[3]}
    kept = rows(merge.merge_first_seen(old, new, ["k"], ["first"], ["arr"]))
    assert kept == {1: ("a", ["x"], False), 2: ("b", None, False), 3: ("c", ["z"], False)}
    assert rows(merge.merge_verified(old, new, ["k"]))[1] == ("a", ["x"], True)
    again = merge.merge_upsert(merge.merge_upsert(old, new, ["k"]), new, ["k"])
    assert rows(again) == rows(new)


def test_ledger_keeps_what_people_wrote(spark):
    cols = "item string, jurisdiction string, resolved boolean, detected_by string"
    ledger = spark.createDataFrame([("gap", "UT", True, "person")], cols)
    cand = spark.createDataFrame([("gap", "UT", False, "tool", 1), ("gap", "AZ", False, "tool", 2), ("gap", "AZ", False, "other", 3)], cols + ", n int")
    assert sorted(tuple(r) for r in merge.ledger_merge(ledger, cand, "n").collect()) == [("gap", "AZ", False, "tool"), ("gap", "UT", True, "person")]


def test_reconciliation_scope(spark):
    ours = spark.createDataFrame([("UT", "abs"), ("AZ", "lp"), ("CO", "llp")], "j string, m string")
    theirs = spark.createDataFrame([("UT", "abs"), ("AZ", "abs"), ("WA", "lp")], "j string, m string")
    got = {tuple(r)[:3] for r in reconcile.frame_reconcile(ours, theirs, ["j", "m"], "m", theirs).select("j", "m", "direction").collect()}
    assert got == {("AZ", "abs", "theirs_not_ours"), ("WA", "lp", "theirs_not_ours"), ("AZ", "lp", "ours_not_theirs")}


def test_gaps_and_cutoff(spark):
    c = spark.createDataFrame([("p", dt.datetime(2020, 1, 1)), ("p", dt.datetime(2020, 7, 19)), ("p", dt.datetime(2020, 8, 1))], "program_id string, t timestamp")
    assert [r["gap_days"] for r in status.capture_gaps(c, "program_id", "t").collect()] == [200]
    own = spark.createDataFrame([("p", dt.datetime(2020, 8, 1))], "program_id string, t timestamp")
    assert quality.before_first_own(c, own, "program_id", "t").count() == 2
    assert quality.before_first_own(c, own.limit(0), "program_id", "t").count() == 3


def test_sequence_gaps_over_ranges(spark):
    ids = spark.createDataFrame([(1,), (2,), (5,), (999_999,), (1_000_003,)], "id long")
    assert sorted(tuple(r) for r in status.sequence_gaps(ids, "id").collect()) == [(3, 4), (6, 999_998), (1_000_000, 1_000_002)]


def test_rules_of_a_declared_table(spark):
    t = TABLES["crosswalk"]
    rows = spark.createDataFrame([("a", 1, None, 0.5, "exact", True, None, None), ("", 2, None, 1.5, None, None, None, None)], t.schema)
    good, bad = quality.validate(rows, quality.table_rules(t, rows.columns))
    assert good.count() == 1 and sorted(bad.first()["errors"]) == ["match_method: required", "match_score: range", "provider_id: required"]
    strict, _ = quality.validate(rows, quality.table_rules(t, rows.columns), strict=True)
    with pytest.raises(Exception, match="match_score"):
        strict.collect()


def test_drift_sees_counts(spark):
    a = spark.createDataFrame([(1,), (1,)], "v int")
    assert quality.release_drift(a, a).count() == 0
    assert [r["side"] for r in quality.release_drift(a, a.limit(1)).collect()] == ["only_first"]


def test_nested_json(spark):
    j = '{"summary": {"n": 2}, "0": {"bill_id": 7}, "1": {"bill_id": null}, "2": "x"}'
    assert [r["item"]["bill_id"] for r in nested.explode_keyed_json(spark.createDataFrame([(j,)], "j string"), "j", ["summary"], "bill_id bigint", "bill_id").collect()] == [7]
    b = '{"results":[{"id":"1","identifier":"HB 1","title":"T","session":"2024","jurisdiction":{"id":"ocd/state:ut/gov"},"latest_action_description":"died","latest_action_date":"0000-00-00","actions":[{"classification":["a","b"]},{"classification":["c"]}],"abstracts":[]}]}'
    r = nested.explode_bills(spark.createDataFrame([(b,)], "j string"), "j").first()
    assert (r["state"], r["classes"], r["action_date"], r["abstract"]) == ("UT", ["a", "b", "c"], None, None)
    i = '[["timestamp","original","statuscode","digest"],["20240102030405","u","200","d"],["20240102030405","u","301","d"],["x","u","200","d"],["1"]]'
    assert [r["captured_at"] for r in nested.parse_capture_index(spark.createDataFrame([(i,)], "j string"), "j").collect()] == [dt.datetime(2024, 1, 2, 3, 4, 5)]


def test_map_paths(spark):
    g = '{"features":[{"properties":{"name":"A"},"geometry":{"type":"Polygon","coordinates":[[[-100,40],[-90,40],[-90,30],[-100,40]]]}},{"properties":{"name":"B"},"geometry":{"type":"MultiPolygon","coordinates":[[[[0,0],[1,1],[0,0]]]]}}]}'
    pts = nested.explode_geojson(spark.createDataFrame([(g,)], "j string"), "j", ["B"])
    x, y = geo.albers(F.col("lon"), F.col("lat"))
    path = geo.ring_paths(geo.fit_viewport(pts.select("shape", "ring", "pos", x.alias("x"), y.alias("y")))).collect()
    assert len(path) == 1 and path[0]["path"].startswith("M") and path[0]["path"].endswith("Z") and path[0]["path"].count("L") == 3


def test_pages(spark):
    h = "<h2>Models</h2><h3>Live</h3><li>A</li><h4>Abroad</h4><li>B</li><h2>Other</h2><li>C</li>"
    rows = pages.heading_inventory(spark.createDataFrame([(1, h)], "id int, h string"), "id", "h").orderBy("pos").collect()
    assert [(r["model_type"], r["bucket"], r["region"], r["item"]) for r in rows] == [("Models", "Live", "Domestic", "A"), ("Models", "Live", "Abroad", "B"), ("Other", None, "Domestic", "C")]
    caps = spark.createDataFrame([("a", "1", b"x,y"), ("a", "2", b""), ("b", "3", b"z")], "program_id string, capture_id string, content binary")
    out = pages.parse_captures(caps, {"a": lambda raw: [{"name": p} for p in raw.decode().split(",") if p]}, "name string").collect()
    assert sorted((r["capture_id"], r["name"] or "", (r["error"] or "").split(":")[0]) for r in out) == [("1", "x", ""), ("1", "y", ""), ("2", "", "no rows"), ("3", "", "KeyError")]


def test_captures_are_handed_on_in_pieces(spark):
    held = [0]

    class Text(str):
        def __del__(self):
            held[0] -= 1

    def roster(raw):
        for i in range(int(raw)):
            held[0] += 1
            yield {"name": Text(i), "held": held[0]}

    def broken(raw):
        yield from roster(raw)
        raise ValueError("cut off")

    caps = spark.createDataFrame([("a", str(k), b"20000") for k in range(6)] + [("b", "6", b"20000"), ("c", "7", b"20000"), ("a", "8", b"0")], "program_id string, capture_id string, content binary").coalesce(1)
    listed = lambda raw: [{"name": str(i)} for i in range(int(raw))]
    out = pages.parse_captures(caps, {"a": roster, "b": broken, "c": listed}, "name string, held int")
    got = {r["capture_id"]: (r["n"], r["names"], r["most"], r["error"]) for r in out.groupBy("capture_id").agg(
        F.count("row_no").alias("n"), F.count_distinct(F.when(F.col("name") == F.col("row_no").cast("string"), F.col("row_no"))).alias("names"), F.max("held").alias("most"), F.max("error").alias("error")).collect()}
    assert all(got[str(k)][:2] == (20000, 20000) and got[str(k)][3] is None for k in (0, 1, 2, 3, 4, 5, 7))
    assert got["6"] == (0, 0, None, "ValueError: cut off") and got["8"] == (0, 0, None, "no rows")
    assert max(got[str(k)][2] for k in range(6)) <= 40000  # of 120,000 rows


def test_roster_lines_are_read_one_by_one():
    raw = b"\n" + b"\n".join(b"%d,active" % i for i in range(50_000)) + b"\n\n1,exited\n"
    tracemalloc.start()
    n = sum(r["status"] == "active" for r in documents._read_roster(raw))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 50_000 and most < 5 * len(raw)
    assert list(documents._read_roster(b"1,a\n\n2,b\n")) == [{"provider_id": "1", "status": "a"}, {"provider_id": "2", "status": "b"}]
    assert list(documents._read_roster(b" \n")) == []
    with pytest.raises(ValueError, match="two cells"):
        list(documents._read_roster(b"1,a\n2"))


def test_the_audit_reads_what_it_checks_once(spark):
    n = F.col("id")
    providers = spark.range(0, 701).select(n.alias("provider_id"), F.when(n % 7 != 3, n % 5).alias("first_seen_snapshot_id"), F.when(n > 0, n % 4).alias("last_seen_snapshot_id"))
    events = spark.range(0, 503).select(n.alias("event_id"), F.when(n != 9, F.when(n == 8, 77).otherwise(n % 4)).alias("source_snapshot_id"))
    snaps = spark.createDataFrame([("a", s, "u" if s else None) for s in (0, 1, 2, 3, 3)] + [("a", None, "u")], "program_id string, snapshot_id long, source_url string")
    programs = spark.createDataFrame([("a",), ("b",)], "program_id string")
    aliases = spark.createDataFrame([(700, "x"), (701, "y"), (None, "z")], "provider_id long, alias_name string")
    errors = quality.provenance_audit(providers, events, snaps, programs, aliases.limit(0))
    plan = errors._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 701,") == 1 and plan.count("Range (0, 503,") == 1
    want = [("provider_first_seen_null", str(i), "first_seen_snapshot_id is null") for i in range(701) if i % 7 == 3]
    want += [("provider_first_seen", str(i), "first_seen_snapshot_id 4 has no row") for i in range(701) if i % 7 != 3 and i % 5 == 4]
    want += [("provider_last_seen_null", "0", "last_seen_snapshot_id is null"), ("event_snapshot_null", "9", "source_snapshot_id is null"), ("event_snapshot", "8", "source_snapshot_id 77 has no row")]
    want += [("snapshot_url_null", "0", "source_url is null"), ("program_without_snapshot", "b", "no snapshot")]
    assert sorted(tuple(r) for r in errors.collect()) == sorted(want)
    named = quality.provenance_audit(providers, events, snaps, programs, aliases).filter("check = 'alias_provider'")
    assert [tuple(r) for r in named.collect()] == [("alias_provider", "y", "provider_id 701 has no row")]


def test_files(spark, tmp_path):
    (tmp_path / "m.csv").write_text("program_id,snapshot_id,source_url,retrieved_at,content_sha256,storage_path,media_type,scraper_version\np,s2,u,2024-01-02T00:00:00+00:00,h,f,html,1\np,s1,u,2024-01-01T00:00:00,h,f,html,1\n")
    m = files.read_manifest(spark, str(tmp_path / "m.csv")).orderBy("seq").collect()
    assert [r["snapshot_id"] for r in m] == ["s1", "s2"] and m[0]["retrieved_at"] == ts(1)
    (tmp_path / "l.csv").write_text("item,jurisdiction,classification,source_url,proposed_action,resolved,detected_by,detected_at\na,UT,c,u,p,False,x,2024-01-01\na,UT,c,u,p,True,x,bad\n")
    led = files.read_ledger(spark, str(tmp_path / "l.csv")).collect()
    assert len(led) == 1 and led[0]["resolved"] and led[0]["detected_at"] is None
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.html").write_bytes(b"hello")
    blobs = files.read_blobs(spark, str(tmp_path / "raw"))
    manifest = spark.createDataFrame([("a.html", "0"), ("b.html", "1")], "path string, sha256 string")
    assert sorted(tuple(r) for r in quality.blob_integrity(manifest, blobs).collect()) == [("a.html", "hash_mismatch"), ("b.html", "missing")]
    t = spark.createDataFrame([(2, ["x"], None), (1, [], "v")], "k int, a array<string>, s string")
    assert files.export_tables({"t": t}, {"t": ["k"]}, str(tmp_path / "out")) == {"t": 2}
    assert [tuple(r) for r in files.csv_frame(t).orderBy("k").collect()] == [("1", "", "v"), ("2", '["x"]', "")]
    assert files.flat_frame(t).orderBy("k").first()["a"] == "[]"


def test_rebuild_backfill_and_resolution(spark, tmp_path):
    man = spark.createDataFrame([("p", "s1", "u", ts(1), "h1"), ("p", "s2", "u", ts(2), "h1"), ("p", "s3", "u", ts(3), "h2"), ("p", "x", "other", ts(3), "h9")], "program_id string, snapshot_id string, source_url string, retrieved_at timestamp, content_sha256 string")
    obs = spark.createDataFrame([("p", ts(1), "A", 1, "active"), ("p", ts(3), "A", 1, "suspended"), ("p", ts(3), "B", 2, "active"), ("p", ts(3), "B", 3, "revoked")], "program_id string, retrieved_at timestamp, provider_id string, row_no int, status string")
    sources = spark.createDataFrame([("p", "u")], "program_id string, canonical_url string")
    programs = spark.createDataFrame([("p",), ("q",)], "program_id string")
    out = jobs.rebuild(man, obs, sources, programs)
    assert sorted((r["provider_id"], r["event_type"], r["new_status"]) for r in out.events.collect()) == [("A", "authorized", "active"), ("A", "status_change", "suspended"), ("B", "authorized", "revoked")]
    assert {r["provider_id"]: r["current_status"] for r in out.providers.collect()} == {"A": "suspended", "B": "revoked"}
    assert [(r["check"], r["key"]) for r in out.errors.collect()] == [("program_without_snapshot", "q")]
    caps = spark.createDataFrame([("p", "c1", ts(1), "d1", None, True), ("p", "c2", ts(2), "d1", None, True), ("p", "c3", ts(3), "d3", "bad", False), ("p", "c4", ts(4), "d4", None, False)], "program_id string, capture_id string, captured_at timestamp, digest string, error string, is_partial boolean")
    own = spark.createDataFrame([("p", ts(20), "own")], "program_id string, captured_at timestamp, snapshot_id string")
    parsed = spark.createDataFrame([("p", "c1", "A", "active")], "program_id string, capture_id string, provider_id string, status string")
    ev, known, gaps, report = jobs.backfill(caps, own, parsed, 5)
    assert sorted(r["snapshot_id"] for r in known.collect()) == ["c1", "own"] and ev.count() == 1 and [g["gap_days"] for g in gaps.collect()] == [19]
    r = report.first()
    assert (r["ingested"], r["skipped"], r["parse_error"], r["empty"], r["partial"]) == (1, 1, 1, 1, 1)
    bills = spark.createDataFrame([("1", "HB 12", "Legal sandbox pilot", "UT", "Signed by governor", dt.date(2024, 1, 1), ["x"], None, "b1"), ("2", "SB 1", "Repeal legal sandbox", "UT", "Died", None, [], None, "b2")], "bill_id string, identifier string, title string, state string, latest_action string, action_date date, classes array<string>, abstract string, url string")
    conf = spark.createDataFrame([("p", "UT", ["sandbox"], ["hb12"], False, None, None, None), ("q", "AZ", ["x"], [], False, "sunset", dt.date(2021, 7, 31), "rule28"), ("r", "AZ", ["x"], [], False, "sunset", dt.date(2021, 7, 31), "rule28"), ("s", "AZ", ["x"], [], False, None, None, None)], "program_id string, state string, queries array<string>, known_bills array<string>, pending_rules boolean, override string, override_sunset date, override_url string")
    prog = spark.createDataFrame([("p", "proposed", "u", None), ("q", "active", "u", None), ("r", "sunset", "u", None), ("s", "active", "u", None)], "program_id string, program_status string, source_url string, sunset_date date")
    got = {x["program_id"]: x for x in jobs.resolve_status(prog, bills, conf).collect()}
    assert (got["p"]["proposed_status"], got["p"]["confidence"], got["p"]["evidence"], got["p"]["is_change"]) == ("active", 1.0, ["1", "2"], True)
    assert (got["q"]["proposed_status"], got["q"]["confidence"], got["q"]["proposed_sunset"], got["q"]["source_url"], got["q"]["is_change"]) == ("sunset", 1.0, dt.date(2021, 7, 31), "rule28", True)
    assert got["r"]["is_change"]  # its sunset date is news
    assert (got["s"]["proposed_status"], got["s"]["confidence"], got["s"]["is_change"], got["s"]["source_url"]) == (None, 0.0, False, None)
    done = {r["program_id"]: tuple(r)[1:] for r in merge.apply_signals(prog, jobs.resolve_status(prog, bills, conf)).collect()}
    assert done == {"p": ("active", "b1", None), "q": ("sunset", "rule28", dt.date(2021, 7, 31)), "r": ("sunset", "rule28", dt.date(2021, 7, 31)), "s": ("active", "u", None)}
    led = spark.createDataFrame([], "item string, jurisdiction string, classification string, resolved boolean, detected_by string")
    inv = spark.createDataFrame([("abs", "Implemented", "UT"), (None, "Implemented", "AZ")], "model_type string, status_bucket string, jurisdiction string")
    ours = spark.createDataFrame([("AZ", "abs")], "jurisdiction string, model_type string")
    merged, state = jobs.completeness(ours, inv, led, ("Implemented",))
    assert merged.count() == 2 and state.first()["unresolved"] == 2
    placed = programs.withColumn("jurisdiction", F.lit("UT"))
    b = jobs.bundle(placed, out.providers, out.events, programs.filter("program_id = 'q'"), str(tmp_path / "bundle"))
    assert {r["program_id"]: r["providers"] for r in b.programs.collect()} == {"p": 2, "q": 0} and b.undocumented.count() == 0
    assert b.roster_sizes.agg(F.sum("change")).first()[0] == 2 and tuple(b.totals.first()) == (2, 1, 2, 0)
    assert [tuple(r) for r in b.places.collect()] == [("UT", ["p", "q"], 2, False)] and spark.read.json(str(tmp_path / "bundle" / "programs.json")).count() == 2
    with pytest.raises(ValueError):
        jobs.publish(out, str(tmp_path / "release"))
    clean = jobs.rebuild(man, obs, sources, programs.filter("program_id = 'p'"))
    assert jobs.publish(clean, str(tmp_path / "release")) == {"provider": 2, "event": 3, "snapshot": 2}
    last, new = (spark.createDataFrame([("p", h)], "program_id string, content_sha256 string") for h in ("h1", "h2"))
    before, now = obs.filter("day(retrieved_at) = 1"), obs.filter("day(retrieved_at) = 3")
    assert [tuple(r) for r in jobs.incremental(before, now, last, new)[1].collect()] == [("p", "updated", 2, 1, 0, 1)]
    events, summary = jobs.incremental(before, now, last, last)
    assert events.count() == 0 and [tuple(r) for r in summary.collect()] == [("p", "unchanged", 2, 0, 0, 0)]
    assert jobs.incremental(before.limit(0), now, last.limit(0), new)[1].first()["run_status"] == "first"


def test_renames_and_match_quality(spark):
    ev = spark.createDataFrame([("p", 2, "A", "disappeared_from_roster"), ("p", 2, "B", "authorized"), ("p", 3, "C", "authorized")], "program_id string, seq int, provider_id string, event_type string")
    nm = spark.createDataFrame([("A", "bee law group"), ("B", "bee law firm"), ("C", "bee law group")], "provider_id string, name string")
    assert [(r["gone"], r["come"], r["similarity"]) for r in match.rename_candidates(ev, nm).collect()] == [("A", "B", 0.5)]


def test_bundles_and_rosters(spark, tmp_path):
    programs = spark.createDataFrame([("p", "P"), ("q", "Q")], "program_id string, name string")
    providers = spark.createDataFrame([("p", "A", "s2", "active"), ("p", "B", "s1", "exited")], "program_id string, provider_id string, last_seen_snapshot_id string, current_status string")
    assert [tuple(r) for r in status.roster_at(providers, "s2").collect()] == [("p", "A", "active")]
    files.write_bundle({"programs": programs, "providers": providers}, str(tmp_path), {"providers": ("programs", "program_id")})
    back = {r["program_id"]: r["providers"] for r in spark.read.json(str(tmp_path / "programs.json")).collect()}
    assert [x["provider_id"] for x in back["p"]] == ["A", "B"] and back["q"] is None


def test_merges_of_repeated_incoming_keys(spark):
    cols = "k int, v string, first string, n int, verified boolean"
    old = spark.createDataFrame([(1, "a", None, 0, False), (9, "z", "f", 0, True)], cols)
    new = spark.createDataFrame([(2, "x", None, 1, False), (2, "y", "b", 2, False), (2, "z", "c", 3, False), (1, "q", "d", 1, True), (1, "r", "e", 2, False), (9, "no", None, 5, False)], cols)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(merge.merge_upsert(old, new, ["k"], ["n"])) == [(1, "r", "e", 2, False), (2, "z", "c", 3, False), (9, "no", None, 5, False)]
    assert rows(merge.merge_insert_new(old, new, ["k"], ["n"])) == [(1, "a", None, 0, False), (2, "x", None, 1, False), (9, "z", "f", 0, True)]
    assert rows(merge.merge_first_seen(old, new, ["k"], ["first"], ["v"], ["n"])) == [(1, "a", "d", 2, False), (2, "x", "b", 3, False), (9, "z", "f", 5, False)]
    assert rows(merge.merge_verified(old, new, ["k"], order=["n"])) == [(1, "q", "d", 1, True), (2, "z", "c", 3, False), (9, "z", "f", 0, True)]
    assert merge.merge_upsert(old, new, ["k"]).count() == 3 and rows(merge.last_wins(new, ["k"], "n"))[1][1] == "z"
    programs = spark.createDataFrame([("p", "active", None, "u")], "program_id string, program_status string, sunset_date date, source_url string")
    two = spark.createDataFrame([("p", True, 0.6, "active", None, "a"), ("p", True, 0.9, "sunset", None, "b")], "program_id string, is_change boolean, confidence double, proposed_status string, proposed_sunset date, source_url string")
    assert rows(merge.apply_signals(programs, two)) == [("p", "sunset", None, "b")]


def test_long_cells_paths_and_junk_rows(spark):
    long = "x\n" + "• item " * 3 + "y" * 1_200_000
    assert len(one(spark, long, parse.bullet_cell)["items"][-1]) > 1_200_000
    assert one(spark, "/root/" + "p" * 1_200_000, lambda c: F.length(parse.relative_path(c, "/root"))) == 1_200_000
    raw = spark.createDataFrame([("Adams, Michelleif ('Y'=='N') {",), ("-",), (" ",), (None,), ("TEST, Account",), ("Bee, Law",)], "cell string")
    assert sorted(r["name"] for r in pages.named_rows(raw, F.col("cell"), ["test"]).collect()) == ["Adams, Michelle", "Bee, Law"]
    t = spark.createDataFrame([("UT", 1), ("AZ", 2), ("UT", 3)], "jurisdiction string, k int")
    got = files.describe_package({"t": t, "u": t.select("k")}).orderBy("table_name").collect()
    assert [tuple(r)[:4] for r in got] == [("t", 3, 2, 2), ("u", 3, 1, None)] and "jurisdiction" in got[0]["schema"]


def test_names_are_paired_by_rare_tokens(spark):
    import random

    r = random.Random(3)
    words = ["law", "group", "legal"] + ["w%d" % i for i in range(30)]
    made = lambda n: [(i, " ".join({*r.sample(words[:3], 2), *r.sample(words, r.randint(1, 4))}), r.choice("xy")) for i in range(n)]
    a, b = made(60), made(60)
    for least in (0.3, 0.5, 0.7):
        want = set()
        for i, n, p in a:
            for j, m, q in b:
                s = len({*n.split()} & {*m.split()}) / len({*n.split()} | {*m.split()})
                if p == q and s >= least:
                    want.add((p, i, j, round(s, 6)))
        got = match.entity_match(spark.createDataFrame(a, "a int, name string, area string"), spark.createDataFrame(b, "b int, name string, area string"), "a", "b", "name", "area", least)
        assert sorted(tuple(x)[:4] for x in got.collect()) == sorted(want)

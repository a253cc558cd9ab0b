"""Queries on pages and files: tables and headings out of markup, a whole rebuild from files, what a package must keep."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import package
from ..sources import markup, pages
from ..sources.schemas import TABLES
from ..sources.scratch import new_path
from ..sources.tables import roster_observations, snapshots, table
from . import jobs
from .diffs import BASE, CHAIN, OBS, SNAPS
from .registry import query

#: One page for each brand: a header, rows of name and size, where each second size goes down over two rows, and a table inside some cells.
_NAME = "concat('<tr><td> <b>', p_name, '</b>', CASE WHEN p_partkey % 7 = 0 THEN concat('<table><tr><td>in ', p_partkey, '</td></tr></table>') ELSE '' END)"


def _brand_pages(spark, d):
    k = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey"))
    rows = table(spark, d, "part").select("p_brand", k.alias("k"), F.concat(F.expr(_NAME), F.when(k % 2 == 1, F.concat(F.lit("<td rowspan=2>"), F.col("p_size").cast("string"))).otherwise("")).alias("row"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "row"))), lambda x: x["row"]), "\n")
    return rows.groupBy("p_brand").agg(F.concat(F.lit("<table><tr><th>Name<th>Size</tr>"), body, F.lit("</table>")).alias("html"))


@query("html_tables", """WITH r AS (SELECT p_brand, p_partkey, p_name, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS k FROM part)
SELECT p_brand, 0 AS table_no, 0 AS depth, CAST(k AS INT) AS row_no, false AS is_header, p_name || '|' || CASE WHEN k % 2 = 1 THEN p_size ELSE lag(p_size) OVER (PARTITION BY p_brand ORDER BY k) END AS cells FROM r
UNION ALL SELECT p_brand, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY k) AS INT), 1, 0, false, 'in ' || p_partkey FROM r WHERE p_partkey % 7 = 0
UNION ALL SELECT DISTINCT p_brand, 0, 0, 0, true, 'Name|Size' FROM part""")
def _(spark, d):
    return markup.html_tables(_brand_pages(spark, d), "p_brand", "html").withColumn("cells", F.array_join("cells", "|"))


@query("named_rows", """WITH r AS (SELECT p_brand, p_name, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS k FROM part)
SELECT p_brand, CAST(k AS INT) AS row_no, p_name AS name FROM r WHERE p_name NOT LIKE '%green%' AND p_partkey % 10 <> 3""")
def _(spark, d):
    rows = pages.extract_html_rows(_brand_pages(spark, d), "p_brand", "html", table=0)
    keys = table(spark, d, "part").select("p_brand", "p_name", "p_partkey", F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey")).alias("row_no"))
    marked = rows.join(keys, ["p_brand", "row_no"]).withColumn("name", F.when(F.col("p_partkey") % 10 == 3, "-").when(F.col("p_name").contains("green"), F.concat(F.lit("Green, "), "p_name")).otherwise(F.concat(F.element_at("cells", 1), F.lit(" if ('x')"))))
    return pages.named_rows(marked, F.col("name"), ["green"]).select("p_brand", "row_no", "name")


@query("page_blocks", r"""WITH t AS (SELECT page_id, regexp_extract_all(html, '<(?:h1|li)>.*?</(?:h1|li)>') AS found FROM pages),
b AS (SELECT page_id, CAST(unnest(range(len(found))) AS INT) AS pos, unnest(found) AS x FROM t),
c AS (SELECT page_id, pos, substr(x, 2, 2) AS tag, trim(regexp_replace(replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM b)
SELECT * FROM c WHERE text <> ''""")
def _(spark, d):
    return markup.html_blocks(table(spark, d, "pages"), "page_id", "html")


@query("heading_walk", """SELECT r_name AS model_raw, lower(r_name) AS model_type, CASE WHEN n_nationkey % 2 = 0 THEN 'Implemented' ELSE 'Proposed' END AS bucket,
CASE WHEN n_nationkey % 2 = 0 THEN 'Domestic' ELSE 'International' END AS region, n_name AS item, CAST(NULL AS VARCHAR) AS problem FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 'AMERICA', 'america', NULL, 'Domestic', 'Early', 'no status bucket'""")
def _(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    items = lambda odd: F.array_join(F.array_sort(F.collect_list(F.when(F.col("n_nationkey") % 2 == odd, F.concat(F.lit("<h4>"), "n_name")))), "")
    parts = n.groupBy("r_name").agg(items(0).alias("even"), items(1).alias("odd"))
    early = F.when(F.col("r_name") == "AMERICA", "<h4>Early</h4>").otherwise("")
    one = F.concat(F.lit("<h3>"), "r_name", F.lit("</h3>"), early, F.lit("<h3>Implemented</h3>"), "even", F.lit("<h3>Proposed</h3><h4>International</h4>"), "odd")
    page = parts.agg(F.concat(F.lit("<h2>About</h2><h4>no</h4><h2>Models</h2>"), F.array_join(F.array_sort(F.collect_list(one)), "\n"), F.lit("<h2>End</h2><h4>no</h4>")).alias("html")).withColumn("page", F.lit(1))
    kinds = {r: r.lower() for r in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")}
    return markup.heading_walk(markup.html_blocks(page, "page", "html"), "page", "Models", kinds).select("model_raw", "model_type", "bucket", "region", "item", "problem")


def _read_roster(raw: bytes) -> Iterator[dict]:
    for line in re.finditer(r"[^\n]+", raw.decode().strip()):
        cells = line[0].split(",")
        if len(cells) != 2:
            raise ValueError("a line without two cells")
        yield {"provider_id": cells[0], "status": cells[1]}


def _from_files(spark, d) -> jobs.FileRebuild:
    """The roster chain as raw files with a manifest: by day, some have other bytes than registered, some are lost, some broken, some empty."""
    obs = roster_observations(spark, d)
    line = F.concat_ws(",", F.col("provider_id").cast("string"), "status")
    day = F.day("snap_date")
    text = F.when(day % 10 == 5, "!broken").when(day % 10 == 9, "").otherwise(F.array_join(F.array_sort(F.collect_list(line)), "\n"))
    made = obs.groupBy("program_id", "snap_date").agg(text.alias("value")).join(snapshots(obs), ["program_id", "snap_date"])
    root = new_path(spark, "captures")
    made.select("snapshot_id", "value").repartition("snapshot_id").write.partitionBy("snapshot_id").text(f"{root}/raw")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/raw").select(F.regexp_extract("path", "snapshot_id=([^/]*)/", 1).alias("snapshot_id"), F.regexp_extract("path", "/raw/(.*)$", 1).alias("storage_path"), F.sha2("content", 256).alias("sha"))
    manifest = made.join(listed, "snapshot_id").select(
        "program_id", "snapshot_id", F.lit("u").alias("source_url"), F.concat(F.col("snap_date").cast("string"), F.lit("T00:00:00")).alias("retrieved_at"),
        F.when(day % 10 == 3, F.repeat(F.lit("0"), F.lit(64))).otherwise(F.col("sha")).alias("content_sha256"),
        F.when(day % 10 == 7, "nowhere").otherwise(F.col("storage_path")).alias("storage_path"), F.lit("html").alias("media_type"), F.lit("1").alias("scraper_version"),
    )
    manifest.write.csv(f"{root}/manifest", header=True)
    programs = made.select("program_id").distinct()
    names = [r[0] for r in programs.collect()]
    sources = programs.withColumn("canonical_url", F.lit("u"))
    return jobs.rebuild_from_files(spark, f"{root}/manifest", f"{root}/raw", dict.fromkeys(names, _read_roster), sources, programs, ["click"])


FILE_OBS = "obs AS (SELECT * FROM obs_all WHERE day(snap_date) % 10 NOT IN (3, 5, 7, 9))"
FILE_BASE = f"WITH {OBS.replace('obs AS', 'obs_all AS', 1)}, {FILE_OBS}, {SNAPS}, {CHAIN} "


@query("rebuild_from_files", FILE_BASE + "SELECT program_id, CAST(provider_id AS VARCHAR) AS provider_id, seq, event_type, new_status, event_id FROM ev")
def _(spark, d):
    return _from_files(spark, d).rebuilt.events.select("program_id", "provider_id", "seq", "event_type", "new_status", "event_id")


@query("rebuild_dispositions", BASE + """SELECT program_id, snapshot_id, CASE WHEN day(snap_date) % 10 IN (3, 5, 7, 9) THEN 0 ELSE n END AS n_rows,
CASE day(snap_date) % 10 WHEN 3 THEN 'hash_mismatch' WHEN 5 THEN 'parse_error' WHEN 7 THEN 'missing' WHEN 9 THEN 'empty' ELSE 'ingested' END AS disposition,
program_id = 'click' AND day(snap_date) % 10 <> 7 AS is_partial FROM (SELECT program_id, snap_date, snapshot_id, count(*) AS n FROM obs JOIN snaps USING (program_id, snap_date) GROUP BY ALL)""")
def _(spark, d):
    return _from_files(spark, d).dispositions.select("program_id", "snapshot_id", "n_rows", "disposition", "is_partial")


@query("rebuild_providers", FILE_BASE + """, last AS (SELECT program_id, provider_id, max_by(new_status, (snap_date, event_id)) AS current_status FROM ev GROUP BY ALL)
SELECT program_id, CAST(provider_id AS VARCHAR) AS provider_id, min_by(snapshot_id, s.seq) AS first_seen_snapshot_id, max_by(snapshot_id, s.seq) AS last_seen_snapshot_id, any_value(current_status) AS current_status
FROM seen JOIN snaps s USING (program_id, seq) JOIN last USING (program_id, provider_id) GROUP BY program_id, seen.provider_id""")
def _(spark, d):
    return _from_files(spark, d).rebuilt.providers.select("program_id", "provider_id", "first_seen_snapshot_id", "last_seen_snapshot_id", "current_status")


@query("rebuild_audit", "SELECT 'program_without_snapshot' AS check, 'none' AS key, 'no snapshot' AS message WHERE false")
def _(spark, d):
    return _from_files(spark, d).rebuilt.errors


_STAMPED = "CASE WHEN {key} % 7 = 0 THEN 'ftp://x' ELSE 'https://x' END AS source_url, CASE WHEN {key} % 11 <> 3 THEN TIMESTAMP '2024-01-01 00:00:00' END AS retrieved_at, '1' AS scraper_version"
PACKAGE = {
    "program": ("nation", f"concat('p', n_nationkey) AS program_id, CASE WHEN n_nationkey % 5 = 0 THEN lower(substr(n_name, 1, 2)) ELSE substr(n_name, 1, 2) END AS jurisdiction, {_STAMPED.format(key='n_nationkey')}"),
    "provider": ("customer", f"concat('c', c_custkey - CASE WHEN c_custkey % 50 = 49 THEN 1 ELSE 0 END) AS provider_id, concat('p', CASE WHEN c_custkey % 30 = 0 THEN 99 ELSE c_nationkey END) AS program_id, CASE WHEN c_custkey % 40 = 1 THEN ' ' ELSE c_name END AS legal_name, CASE WHEN c_custkey % 60 = 2 THEN 'robot' ELSE 'entity' END AS provider_type, CASE WHEN c_acctbal < 0 THEN 'gone' ELSE 'active' END AS current_status, {_STAMPED.format(key='c_custkey')}"),
    "crosswalk": ("orders", "concat('c', o_custkey) AS provider_id, o_orderkey AS cl_docket_id, o_totalprice / 400000 AS match_score, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE 'name' END AS match_method"),
}
_PACKAGE_SQL = ", ".join(f"{name} AS (SELECT {columns} FROM {source})" for name, (source, columns) in PACKAGE.items())


@query("package_checks", f"""WITH {_PACKAGE_SQL}, found AS (
SELECT 'program' AS table_name, 'program_name: missing' AS check, 1 AS n UNION ALL SELECT 'program', 'jurisdiction: pattern', count(*) FROM program WHERE NOT regexp_matches(jurisdiction, '^[A-Z]{{2}}$')
UNION ALL SELECT 'program', 'source_url: pattern', count(*) FROM program WHERE source_url LIKE 'ftp%' UNION ALL SELECT 'program', 'retrieved_at: required', count(*) FROM program WHERE retrieved_at IS NULL
UNION ALL SELECT 'provider', 'source_url: pattern', count(*) FROM provider WHERE source_url LIKE 'ftp%' UNION ALL SELECT 'provider', 'retrieved_at: required', count(*) FROM provider WHERE retrieved_at IS NULL
UNION ALL SELECT 'provider', 'legal_name: required', count(*) FROM provider WHERE trim(legal_name) = '' UNION ALL SELECT 'provider', 'provider_type: value', count(*) FROM provider WHERE provider_type = 'robot'
UNION ALL SELECT 'provider', 'current_status: value', count(*) FROM provider WHERE current_status = 'gone' UNION ALL SELECT 'provider', 'key: repeated', count(*) - count(DISTINCT provider_id) FROM provider
UNION ALL SELECT 'provider', 'program_id: no parent', count(*) FROM provider WHERE program_id NOT IN (SELECT program_id FROM program)
UNION ALL SELECT 'crosswalk', 'match_score: range', count(*) FROM crosswalk WHERE match_score > 1 UNION ALL SELECT 'crosswalk', 'match_method: required', count(*) FROM crosswalk WHERE match_method IS NULL
UNION ALL SELECT 'crosswalk', 'provider_id: no parent', count(*) FROM crosswalk WHERE provider_id NOT IN (SELECT provider_id FROM provider))
SELECT * FROM found WHERE n > 0""")
def _(spark, d):
    return package.check_package({name: table(spark, d, source).selectExpr(*_split(columns)) for name, (source, columns) in PACKAGE.items()}, TABLES)


def _split(columns: str) -> list[str]:
    """The expressions of a list: commas in brackets don't divide them."""
    out, depth = [""], 0
    for c in columns:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


@query("package_columns", " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column, count(*) AS n_rows, count(*) - count({c}) AS n_nulls FROM {t}" for t, c in (("nation", "n_name"), ("region", "r_name"), ("documents", "text"), ("documents", "lang"), ("labels", "toxic"))))
def _(spark, d):
    described = package.describe({t: table(spark, d, t) for t in ("nation", "region", "documents", "labels")}, TABLES)
    rows = described.select("table_name", F.explode("n_nulls").alias("column", "n_nulls"), "n_rows")
    return rows.filter(F.col("column").isin("n_name", "r_name", "text", "lang", "toxic"))

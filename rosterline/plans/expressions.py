"""Queries on names, labels, lists, dates, links, signals and maps."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geo, names, parse, signals
from ..sources import files, nested, pages
from ..sources.scratch import new_path
from ..sources.tables import table
from .registry import query

SQL_SUFFIX = r"(^|[^\p{L}\p{N}_])(pllc|l\.l\.c\.|l\.l\.p\.|p\.c\.|llc|llp|ltd|inc|co|pc)($|[^\p{L}\p{N}_])"
SQL_CLEAN = r"(^|[^\p{L}\p{N}_])(pllc|llc|llp|ltd|inc|co|pc)($|[^\p{L}\p{N}_])"


def sql_name(c: str) -> str:
    """Normal form of a name in SQL; suffixes are taken off twice, as a match consumes the boundary it shares with the next."""
    s = f"regexp_replace(lower(strip_accents({c})), '\\s*&\\s*', ' and ', 'g')"
    for p in (SQL_SUFFIX, SQL_SUFFIX):
        s = f"regexp_replace({s}, '{p}', '\\1 \\3', 'g')"
    s = f"trim(regexp_replace(regexp_replace({s}, '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
    for p in (SQL_CLEAN, SQL_CLEAN):
        s = f"regexp_replace({s}, '{p}', '\\1 \\3', 'g')"
    s = f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"
    return f"trim(regexp_replace({s}, '^the\\s+', ''))"


RAW_NAME = "CASE p_partkey % 5 WHEN 0 THEN 'The ' || p_name || ', LLC' WHEN 1 THEN p_name || ' & Sons P.C.' WHEN 2 THEN upper(p_name) || ' Inc.' WHEN 3 THEN 'Ávila ' || p_name || ' PLLC' ELSE p_name END"


def parts(spark, d):
    return table(spark, d, "part").withColumn("raw", F.expr(RAW_NAME))


@query("normalize_name", f"SELECT p_partkey, {sql_name(RAW_NAME)} AS name FROM part")
def _(spark, d):
    return parts(spark, d).select("p_partkey", names.normalize_name(F.col("raw")).alias("name"))


@query("normalize_title", f"SELECT page_id, {sql_name(chr(40) + 'regexp_extract(html, ' + chr(39) + '<title>([^<]*)' + chr(39) + ', 1)' + chr(41))} AS title FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", names.normalize_name(F.regexp_extract("html", "<title>([^<]*)", 1)).alias("title"))


@query("provider_id_hash", f"SELECT p_partkey, 'prov_' || substr(sha256(p_brand || chr(0) || {sql_name(RAW_NAME)}), 1, 12) AS provider_id FROM part")
def _(spark, d):
    return parts(spark, d).select("p_partkey", names.provider_id("prov", F.col("p_brand"), F.col("raw")).alias("provider_id"))


@query("id_extract", "SELECT s_suppkey, 'lic_' || regexp_extract(s_name, '^Supplier#(\\d+)$', 1) AS licence FROM supplier WHERE regexp_matches(s_name, '^Supplier#(\\d+)$')")
def _(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", names.licence_id("lic", F.col("s_name"), r"^Supplier#(\d+)$").alias("licence")).filter("licence is not null")


@query("status_map", "SELECT o_orderkey, CASE lower(trim(o_orderstatus)) WHEN 'o' THEN 'active' WHEN 'f' THEN 'exited' ELSE 'unknown' END AS status FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", parse.label_status(F.col("o_orderstatus"), {"O": "active", "F": "exited"}).alias("status"))


SQL_LABEL = "CASE o_orderpriority WHEN '1-URGENT' THEN 'Board Approved' WHEN '2-HIGH' THEN 'Not Authorized' WHEN '3-MEDIUM' THEN 'Under Review' WHEN '4-NOT SPECIFIED' THEN 'Active (participating)' ELSE 'Filed' END"
SQL_TOKENS = f"regexp_extract_all(lower({SQL_LABEL}), '[a-z]+')"
NEG = "['not','under','pending','review','denied','rejected','revoked','withdrawn','declined','closed','inactive','suspended']"
POS = "['authorized','approved','participating','active']"


@query("token_status", f"SELECT o_orderkey, NOT list_has_any({SQL_TOKENS}, {NEG}) AND list_has_any({SQL_TOKENS}, {POS}) AS authorized, lower({SQL_LABEL}) <> 'under review' AND NOT (NOT list_has_any({SQL_TOKENS}, {NEG}) AND list_has_any({SQL_TOKENS}, {POS})) AS unrecognised FROM orders")
def _(spark, d):
    o = table(spark, d, "orders").withColumn("label", F.expr(SQL_LABEL))
    return o.select("o_orderkey", parse.is_authorized(F.col("label")).alias("authorized"), parse.is_unrecognised(F.col("label")).alias("unrecognised"))


@query("split_list", "SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(replace(p_name, ' ', ' , ,'), ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS items FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", F.array_join(parse.split_list(F.replace(F.col("p_name"), F.lit(" "), F.lit(" , ,"))), "|").alias("items"))


AREAS_TEXT = "CASE p_partkey % 4 WHEN 0 THEN 'Family, Civil and Criminial' WHEN 1 THEN 'civil & CIVIL, tax' WHEN 2 THEN 'Juvenile' ELSE '' END"


@query("alias_split", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Family|Civil|Criminal' WHEN 1 THEN 'Civil' WHEN 2 THEN 'Juvenile' ELSE '' END AS areas FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", F.array_join(parse.known_items(F.expr(AREAS_TEXT), parse.AREAS), "|").alias("areas"))


@query("flip_name", "SELECT p_partkey, CASE WHEN strpos(p_name, ' ') > 0 THEN trim(split_part(p_name, ' ', 2)) || ' ' || trim(split_part(p_name, ' ', 1)) ELSE p_name END AS name FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", names.flip_name(F.replace(F.col("p_name"), F.lit(" "), F.lit(", "))).alias("name"))


@query("full_name", "SELECT c_custkey, 'C ' || trim(c_name) AS name FROM customer WHERE trim(c_name) <> ''")
def _(spark, d):
    return table(spark, d, "customer").select("c_custkey", names.full_name(F.lit(" C "), F.col("c_name")).alias("name")).filter("name is not null")


@query("clean_name", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name || 'Corp.' WHEN 1 THEN p_name ELSE p_name || ' J.' END AS name FROM part")
def _(spark, d):
    raw = F.expr("CASE p_partkey % 3 WHEN 0 THEN p_name || ' (Expired). ' || 'Corp.**' WHEN 1 THEN p_name || ' (withdrew)' ELSE p_name || ' J.*' END")
    return table(spark, d, "part").select("p_partkey", names.clean_name(raw).alias("name"))


@query("short_name", "SELECT n_nationkey, 'The ' || n_name || ' Pilot' AS name FROM nation")
def _(spark, d):
    raw = F.concat(F.lit("The Program"), F.lit(" "), F.col("n_name"), F.lit(" Pilot"))
    return table(spark, d, "nation").select("n_nationkey", names.short_name(F.regexp_replace(raw, "The Program ", "The Program ")).alias("name"))


@query("service_models", "SELECT p_partkey, CASE WHEN p_name = '' THEN NULL ELSE '{\"service_models\":[\"' || array_to_string(string_split(p_name, ' '), '\",\"') || '\",\"Software\"]}' END AS ownership, CASE WHEN p_name = '' THEN NULL ELSE true END AS uses_technology FROM part")
def _(spark, d):
    m = parse.service_models(F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit(", ")), F.lit(", Software.")))
    return table(spark, d, "part").select("p_partkey", m.alias("m")).select("p_partkey", "m.ownership", "m.uses_technology")


@query("keyword_flag", "SELECT doc_id, CASE WHEN text <> '' THEN regexp_matches(text, '(?i)\\bthe\\b|licen[sc]e') END AS flag FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", parse.keyword_flag(F.col("text"), r"(?i)\bthe\b|licen[sc]e").alias("flag"))


@query("bullet_cell", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS approved, 'family law matters|housing' AS areas FROM orders")
def _(spark, d):
    cell = F.concat(F.date_format("o_orderdate", "MMMM d, yyyy"), F.lit("\n• family law\nmatters\n • housing\n"))
    return table(spark, d, "orders").select("o_orderkey", parse.bullet_cell(cell).alias("b")).select("o_orderkey", F.col("b.date").alias("approved"), F.array_join("b.items", "|").alias("areas"))


@query("multi_format_date", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders")
def _(spark, d):
    text = F.expr("CASE o_orderkey % 4 WHEN 0 THEN date_format(o_orderdate, \"MMM'.' d, yyyy\") WHEN 1 THEN date_format(o_orderdate, 'MMMM d, yyyy') WHEN 2 THEN date_format(o_orderdate, 'MMM d, yyyy') ELSE 'soon' END")
    return table(spark, d, "orders").select("o_orderkey", parse.first_date(text).alias("day"))


@query("tolerant_date", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders")
def _(spark, d):
    text = F.expr("CASE WHEN o_orderkey % 3 = 0 THEN '0000-00-00' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END")
    return table(spark, d, "orders").select("o_orderkey", parse.tolerant_date(text).alias("day"))


@query("cut_at_marker", "SELECT page_id, length(trim(split_part(html, '<script>', 1))) AS n FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", F.length(parse.cut_at(F.col("html"), "<script>")).alias("n"))


@query("first_external_link", "SELECT page_id, list_filter(regexp_extract_all('href=\"' || url || '\"' || html, 'href=\"(https?://[^\"]*)\"', 1), lambda x: NOT contains(x, '.example.org'))[1] AS link FROM pages")
def _(spark, d):
    html = F.concat(F.lit('href="'), F.col("url"), F.lit('"'), F.col("html"))
    return table(spark, d, "pages").select("page_id", parse.first_external_link(html, ".example.org").alias("link"))


@query("place_lookup", "SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'UT' WHEN 1 THEN 'DC' END AS code FROM nation")
def _(spark, d):
    raw = F.expr("CASE n_nationkey % 3 WHEN 0 THEN ' Utah (through its Sandbox) ' WHEN 1 THEN 'Washington, D.C.' ELSE n_name END")
    return parse.place_code(table(spark, d, "nation").withColumn("place", raw), "place").select("n_nationkey", "code")


@query("region_code", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'UT' ELSE upper(substr(c_mktsegment, 1, 2)) END AS code FROM customer")
def _(spark, d):
    return table(spark, d, "customer").select("c_custkey", parse.region_code(F.expr("CASE WHEN c_custkey % 2 = 0 THEN 'ocd/country:us/state:ut/gov' ELSE c_mktsegment END")).alias("code"))


def contains_any(c, tokens):
    return " OR ".join(f"contains({c}, '{t}')" for t in tokens)


@query("text_direction", f"SELECT doc_id, CASE WHEN ({contains_any('lower(text)', signals.NEGATIVE)}) AND ({contains_any('lower(text)', signals.POSITIVE)}) THEN 'neutral' WHEN {contains_any('lower(text)', signals.NEGATIVE)} THEN 'negative' WHEN {contains_any('lower(text)', signals.POSITIVE)} THEN 'positive' ELSE 'unknown' END AS direction FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", signals.direction(F.col("text")).alias("direction"))


@query("token_counts", "SELECT doc_id, " + " + ".join(f"CAST(contains(lower(text), '{t}') AS INT)" for t in signals.NEGATIVE) + " AS against, " + " + ".join(f"CAST(contains(lower(text), '{t}') AS INT)" for t in signals.POSITIVE) + " AS pro FROM documents")
def _(spark, d):
    low = F.lower("text")
    return table(spark, d, "documents").select("doc_id", signals.count_in(low, signals.NEGATIVE).alias("against"), signals.count_in(low, signals.POSITIVE).alias("pro"))


ACTION = "CASE o_orderkey % 4 WHEN 0 THEN 'Signed by Governor' WHEN 1 THEN 'Died in committee' WHEN 2 THEN 'Referred' ELSE 'Vetoed' END"
CLASSES = "CASE WHEN o_orderkey % 6 = 2 THEN array('filing', 'became-law') ELSE array('filing') END"


@query("phrase_flags", "SELECT o_orderkey, o_orderkey % 4 = 0 OR o_orderkey % 6 = 2 AS enacted, o_orderkey % 4 IN (1, 3) AS failed FROM orders")
def _(spark, d):
    a = F.expr(ACTION)
    return table(spark, d, "orders").select("o_orderkey", signals.enacted(a, F.expr(CLASSES)).alias("enacted"), signals.failed(a).alias("failed"))


SCORE_SQL = "least(1.0, CASE WHEN p_partkey % 10 = 0 THEN 0.5 ELSE 0 END + 0.15 * (CAST(contains(p_name, 'ring') AS INT) + CAST(contains(p_name, 'red') AS INT)) + CASE WHEN p_size > 25 THEN 0.2 ELSE 0 END)"


def scored(spark, d):
    p = table(spark, d, "part")
    ident = F.when(F.col("p_partkey") % 10 == 0, "HB 12 34").otherwise("SB 9")
    return p.withColumn("score", signals.relevance(ident, F.col("p_name"), F.col("p_size") > 25, F.array(F.lit("Ring"), F.lit("red")), F.array(F.lit("hb1234"))))


@query("relevance_score", f"SELECT p_partkey, round(CAST({SCORE_SQL} AS DOUBLE), 6) AS score FROM part")
def _(spark, d):
    return scored(spark, d).select("p_partkey", F.round("score", 6).alias("score"))


WAY = "CASE p_partkey % 3 WHEN 0 THEN 'negative' WHEN 1 THEN 'positive' ELSE 'neutral' END"


@query("status_decision", f"""WITH s AS (SELECT *, CAST({SCORE_SQL} AS DOUBLE) AS score, {WAY} AS way, p_size > 25 AS enacted, p_size % 7 = 0 AS failed FROM part),
t AS (SELECT *, CASE WHEN score < 0.3 THEN NULL WHEN way = 'negative' AND enacted THEN 'sunset' WHEN way = 'positive' AND enacted THEN CASE WHEN p_size % 2 = 0 THEN 'proposed' ELSE 'active' END WHEN way = 'positive' AND NOT failed THEN 'proposed' END AS proposed FROM s)
SELECT p_partkey, proposed, round(CASE WHEN score >= 0.3 AND way = 'negative' AND NOT enacted THEN score * 0.4 ELSE score END, 6) AS confidence, coalesce(proposed IS NOT NULL AND proposed <> 'active', false) AS is_change FROM t""")
def _(spark, d):
    s = scored(spark, d).withColumns({"way": F.expr(WAY), "enacted": F.col("p_size") > 25, "failed": F.col("p_size") % 7 == 0})
    s = s.withColumn("proposed", signals.proposed_status(F.col("score"), F.col("way"), F.col("enacted"), F.col("failed"), F.col("p_size") % 2 == 0))
    return s.select("p_partkey", "proposed", F.round(signals.proposal_confidence(F.col("score"), F.col("way"), F.col("enacted")), 6).alias("confidence"), signals.is_change(F.lit("active"), F.col("proposed"), F.lit(None).cast("date")).alias("is_change"))


@query("relative_path", "SELECT page_id, CASE WHEN starts_with(url, 'https://blog.tionsh.example.net/') THEN substr(url, 33) ELSE url END AS path FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", parse.relative_path(F.col("url"), "https://blog.tionsh.example.net").alias("path"))


@query("iso_utc", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS t FROM events")
def _(spark, d):
    return table(spark, d, "events").select("event_id", parse.iso_utc(F.col("ts")).alias("t"))


@query("html_escape", "SELECT page_id, replace(replace(replace(regexp_extract(html, '<title>([^<]*)', 1), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS title FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", parse.html_escape(F.regexp_extract("html", "<title>([^<]*)", 1)).alias("title"))


@query("albers_project", """WITH c AS (SELECT c_custkey, -125 + (c_custkey % 60) AS lon, 25 + (c_custkey % 24) AS lat, (sin(radians(29.5)) + sin(radians(45.5))) / 2 AS n FROM customer),
k AS (SELECT *, power(cos(radians(29.5)), 2) + 2 * n * sin(radians(29.5)) AS c FROM c)
SELECT c_custkey, round(sqrt(c - 2 * n * sin(radians(lat))) / n * sin(n * (radians(lon) - radians(-96))), 6) AS x, round(sqrt(c - 2 * n * sin(radians(lat))) / n * cos(n * (radians(lon) - radians(-96))) - sqrt(c - 2 * n * sin(radians(38))) / n, 6) AS y FROM k""")
def _(spark, d):
    x, y = geo.albers(F.lit(-125) + F.col("c_custkey") % 60, F.lit(25) + F.col("c_custkey") % 24)
    return table(spark, d, "customer").select("c_custkey", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


@query("viewport_fit", """WITH p AS (SELECT c_custkey, c_acctbal AS x, CAST(c_custkey % 97 AS DOUBLE) AS y FROM customer), e AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM p)
SELECT c_custkey, round((x - x0) * least(920 / (x1 - x0), 560 / (y1 - y0)) + 20, 4) AS px, round((y - y0) * least(920 / (x1 - x0), 560 / (y1 - y0)) + 20, 4) AS py FROM p, e""")
def _(spark, d):
    p = table(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("x"), (F.col("c_custkey") % 97).cast("double").alias("y"))
    return geo.fit_viewport(p).select("c_custkey", F.round("px", 4).alias("px"), F.round("py", 4).alias("py"))


@query("tristate", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'Unknown' WHEN p_size % 3 = 1 THEN 'Yes' ELSE 'No' END AS label FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", parse.tristate(F.when(F.col("p_size") % 3 != 0, F.col("p_size") % 3 == 1)).alias("label"))


@query("build_url", "SELECT n_nationkey, 'https://x.example/' || lower(n_name) || '/a-b/' || CAST(n_nationkey AS VARCHAR) AS url FROM nation")
def _(spark, d):
    return table(spark, d, "nation").select("n_nationkey", parse.build_url("https://x.example/", F.col("n_name"), F.lit("a b"), F.concat(F.lit(" "), F.col("n_nationkey").cast("string"))).alias("url"))


@query("unwrap_url", "SELECT page_id, nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS source FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", parse.unwrap_url(F.col("url"), "utm_source").alias("source"))


@query("json_keyed_explode", "SELECT event_id, k AS key, CAST(json_extract(props, '$.' || k) AS BIGINT) AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)")
def _(spark, d):
    wrapped = table(spark, d, "events").select("event_id", F.concat(F.lit('{"summary": {"x": 1}, "k": '), "props", F.lit("}")).alias("j"))
    return nested.explode_keyed_json(wrapped, "j", ["summary"], "k bigint", "k").select("event_id", "key", F.col("item.k").alias("value"))


@query("compact_ts_parse", "SELECT event_id, date_trunc('second', ts) AS t FROM events")
def _(spark, d):
    j = F.concat(F.lit('[["timestamp","original","statuscode","digest"],["'), F.date_format("ts", "yyyyMMddHHmmss"), F.lit('","u","200","d"],["x","u","404","d"],["1","u"]]'))
    return nested.parse_capture_index(table(spark, d, "events").select("event_id", j.alias("j")), "j").select("event_id", F.col("captured_at").cast("timestamp_ntz").alias("t"))


@query("nested_flatten", "SELECT conv_id, count(*) AS n, string_agg(role, ',' ORDER BY turn) AS roles FROM conversations GROUP BY conv_id")
def _(spark, d):
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.array("role").alias("roles")))).alias("turns"))
    flat = F.flatten(F.transform("turns", lambda t: t.roles))
    return c.select("conv_id", F.size(flat).cast("long").alias("n"), F.array_join(flat, ",").alias("roles"))


@query("html_list_items", "SELECT page_id, i - 1 AS item_no, trim(regexp_replace(regexp_replace(items[i], '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS item FROM (SELECT page_id, items, unnest(generate_series(1, len(items))) AS i FROM (SELECT page_id, regexp_extract_all(html, '<li>(.*?)</li>', 1) AS items FROM pages))")
def _(spark, d):
    return pages.extract_items(table(spark, d, "pages"), "page_id", "html", "<li>(.*?)</li>")


@query("html_links", "SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS item FROM pages")
def _(spark, d):
    return pages.extract_items(table(spark, d, "pages"), "page_id", "html", '<a href="([^"]*)"').select("page_id", "item")


@query("html_rows", "SELECT p_partkey, CAST(0 AS INT) AS row_no, p_name || '|' || p_brand AS cells FROM part")
def _(spark, d):
    html = F.concat(F.lit("<table><tr><td> <b>"), "p_name", F.lit("</b></td>\n<td>"), "p_brand", F.lit("</td></tr><tr><td>short</td></tr></table>"))
    rows = pages.extract_html_rows(table(spark, d, "part").withColumn("html", html), "p_partkey", "html", least_cells=2)
    return rows.select("p_partkey", "row_no", F.array_join("cells", "|").alias("cells"))


@query("line_extract", "SELECT doc_id, i - 1 AS line_no, regexp_extract(ls[i], '^(\\S+) (.+)$', 1) AS first, length(regexp_extract(ls[i], '^(\\S+) (.+)$', 2)) AS rest FROM (SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)) WHERE regexp_matches(ls[i], '^(\\S+) (.+)$')")
def _(spark, d):
    out = pages.extract_lines(table(spark, d, "documents"), "doc_id", "text", r"^(\S+) (.+)$", {"first": 1, "rest": 2})
    return out.withColumn("rest", F.length("rest"))


@query("heading_carry_forward", """SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN length(text) END IGNORE NULLS) OVER (PARTITION BY conv_id, r ORDER BY turn ROWS UNBOUNDED PRECEDING) AS n
FROM (SELECT *, sum(CASE WHEN turn % 4 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations)""")
def _(spark, d):
    c = table(spark, d, "conversations")
    return pages.carry_forward(c, "conv_id", "turn", {"n": F.when(F.col("role") == "user", F.length("text"))}, F.col("turn") % 4 == 0).select("conv_id", "turn", "n")


@query("csv_array_serialize", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, '[\"' || array_to_string(string_split(p_name, ' '), '\",\"') || '\"]' AS words, '' AS none, '' AS missing FROM part")
def _(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.split("p_name", " ").alias("words"), F.array().cast("array<string>").alias("none"), F.lit(None).cast("string").alias("missing"))
    return files.csv_frame(p)


@query("flat_export", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS o_orderdate, '[]' AS none, '' AS missing FROM orders")
def _(spark, d):
    return files.flat_frame(table(spark, d, "orders").select("o_orderkey", "o_orderdate", F.array().cast("array<string>").alias("none"), F.lit(None).cast("string").alias("missing")))


@query("register_captures", "SELECT doc_id, sha256(text) AS sha256, 'snap_' || substr(sha256(text), 1, 16) AS snapshot_id, sha256(text) || '.html' AS storage_path, row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1 AND doc_id % 10 <> 0 AS is_new FROM documents")
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    out = files.register_captures(docs, "text", F.lit("html"), ["doc_id"])
    return out.withColumn("is_new", F.col("is_new") & (F.col("doc_id") % 10 != 0)).select("doc_id", "sha256", "snapshot_id", "storage_path", "is_new")


@query("export_sorted", "SELECT o_orderkey, o_custkey, true AS in_order FROM orders")
def _(spark, d):
    folder = new_path(spark, "release")
    files.export_tables({"orders": table(spark, d, "orders").select("o_orderkey", "o_custkey")}, {"orders": ["o_orderkey"]}, folder)
    written = spark.read.parquet(f"{folder}/orders.parquet").select("*", "_metadata.file_name", "_metadata.row_index")
    before = F.lag("o_orderkey").over(Window.partitionBy("file_name").orderBy("row_index"))
    return written.select("o_orderkey", "o_custkey", F.coalesce(before <= F.col("o_orderkey"), F.lit(True)).alias("in_order"))


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@query("package_rowcounts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows, (SELECT count(*) FROM (DESCRIBE {t})) AS n_columns FROM {t}" for t in TABLES))
def _(spark, d):
    return files.describe_package({t: table(spark, d, t) for t in TABLES}).select("table_name", "n_rows", "n_columns")

"""Queries on what is read and written: declared tables, ledgers, maps, bundles, orders of reports, merges of repeated keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.names import alias_names
from ..operators import counts, merge, status
from ..sources import files, nested
from ..sources.scratch import new_path
from ..sources.tables import load_table, table
from . import jobs
from .registry import query


@query("load_declared", "SELECT doc_id, lang FROM documents")
def _(spark, d):
    return load_table(spark, f"{d}/documents.parquet", T.StructType.fromDDL("doc_id long, lang string"))


@query("ledger_read", """SELECT c_mktsegment AS item, 'J' || c_nationkey AS jurisdiction, 'd' || c_custkey % 3 AS detected_by, 'second ' || max(c_custkey) AS classification, max(c_custkey) % 2 = 0 AS resolved, DATE '2024-02-01' AS detected_at
FROM customer GROUP BY 1, 2, 3""")
def _(spark, d):
    """Two files with the same keys, each with rows of one key in turn: the last row of the second file stays."""
    folder = new_path(spark, "ledger")
    key = [F.col("c_mktsegment").alias("item"), F.concat(F.lit("J"), "c_nationkey").alias("jurisdiction")]
    rows = table(spark, d, "customer").select(
        *key, F.concat(F.lit("first "), "c_custkey").alias("classification"), F.lit("u").alias("source_url"), F.lit("").alias("proposed_action"), F.when(F.col("c_custkey") % 2 == 0, "True").otherwise("false").alias("resolved"),
        F.concat(F.lit("d"), F.col("c_custkey") % 3).alias("detected_by"), F.lit("2024-02-01").alias("detected_at"), "c_custkey",
    )
    for name, part in (("a", rows), ("b", rows.withColumn("classification", F.concat(F.lit("second "), "c_custkey")))):
        part.coalesce(1).sortWithinPartitions("c_custkey").drop("c_custkey").write.csv(f"{folder}/{name}", header=True)
    return files.read_ledger(spark, f"{folder}/*").select("item", "jurisdiction", "detected_by", "classification", "resolved", "detected_at")


#: A square for each nation, those of odd keys as a multi-polygon of two.
_RING = "array(array({x}, {y}), array({x} + 1, {y}), array({x} + 1, {y} + 1), array({x}, {y}))"


def _shapes(spark, d) -> DataFrame:
    n = table(spark, d, "nation").withColumn("x", (F.col("n_nationkey") * 2 - 120).cast("double")).withColumn("y", (F.col("n_nationkey") % 5 * 4 + 26).cast("double"))
    ring, other = F.expr(_RING.format(x="x", y="y")), F.expr(_RING.format(x="x", y="(y + 2)"))
    one = F.struct(F.lit("Polygon").alias("type"), F.to_json(F.array(ring)).alias("c"))
    two = F.struct(F.lit("MultiPolygon").alias("type"), F.to_json(F.array(F.array(ring), F.array(other))).alias("c"))
    g = F.when(F.col("n_nationkey") % 2 == 0, one).otherwise(two)
    feature = F.concat(F.lit('{"properties":{"name":"'), "n_name", F.lit('"},"geometry":{"type":"'), g["type"], F.lit('","coordinates":'), g["c"], F.lit("}}"))
    return n.agg(F.concat(F.lit('{"features":['), F.array_join(F.collect_list(feature), ","), F.lit("]}")).alias("geojson"))


SHAPE_SQL = """n AS (SELECT n_name, n_nationkey, n_nationkey * 2 - 120 AS x, n_nationkey % 5 * 4 + 26 AS y FROM nation),
pts AS (SELECT n_name, n_nationkey, CAST(r AS INT) AS ring, CAST(p AS INT) AS pos, CAST(x + [0, 1, 1, 0][p + 1] AS DOUBLE) AS lon, CAST(y + [0, 0, 1, 0][p + 1] + 2 * r AS DOUBLE) AS lat
  FROM n, range(0, 2) t(r), range(0, 4) u(p) WHERE r = 0 OR n_nationkey % 2 = 1)"""


@query("geojson_points", f"WITH {SHAPE_SQL} SELECT n_name AS shape, ring, pos, lon, lat FROM pts WHERE n_name <> 'CHINA'")
def _(spark, d):
    return nested.explode_geojson(_shapes(spark, d), "geojson", ["CHINA"])


@query("bundle_map", f"""WITH {SHAPE_SQL}, k AS (SELECT *, (sin(radians(29.5)) + sin(radians(45.5))) / 2 AS n FROM pts), c AS (SELECT *, power(cos(radians(29.5)), 2) + 2 * n * sin(radians(29.5)) AS c FROM k),
a AS (SELECT *, sqrt(c - 2 * n * sin(radians(lat))) / n * sin(n * (radians(lon) - radians(-96))) AS x, sqrt(c - 2 * n * sin(radians(lat))) / n * cos(n * (radians(lon) - radians(-96))) - sqrt(c - 2 * n * sin(radians(38))) / n AS y FROM c),
e AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM a),
f AS (SELECT n_nationkey, ring, pos, printf('%.1f,%.1f', (x - x0) * least(920 / (x1 - x0), 560 / (y1 - y0)) + 20, (y - y0) * least(920 / (x1 - x0), 560 / (y1 - y0)) + 20) AS p FROM a, e),
r AS (SELECT n_nationkey, ring, 'M' || string_agg(p, 'L' ORDER BY pos) || 'Z' AS p FROM f GROUP BY 1, 2)
SELECT n_nationkey AS jurisdiction, string_agg(p, ' ' ORDER BY ring) AS path FROM r GROUP BY 1""")
def _(spark, d):
    names = table(spark, d, "nation").select(F.col("n_name").alias("shape"), F.col("n_nationkey").cast("string").alias("jurisdiction"))
    return jobs.map_paths(_shapes(spark, d), names).withColumn("jurisdiction", F.col("jurisdiction").cast("int"))


@query("bundle_written", """SELECT r_regionkey AS program_id, r_name AS name, (SELECT string_agg(n_nationkey || ':' || n_name, ',' ORDER BY n_nationkey) FROM nation WHERE n_regionkey = r_regionkey) AS rows FROM region""")
def _(spark, d):
    folder = new_path(spark, "bundle")
    nations = table(spark, d, "nation").select(F.col("n_regionkey").alias("program_id"), F.col("n_nationkey").alias("k"), "n_name")
    files.write_bundle({"programs": table(spark, d, "region").select(F.col("r_regionkey").alias("program_id"), F.col("r_name").alias("name")), "nations": nations}, folder, {"nations": ("programs", "program_id")})
    back = spark.read.schema("program_id int, name string, nations array<struct<k:int,n_name:string>>").json(f"{folder}/programs.json")
    return back.select("program_id", "name", F.array_join(F.transform("nations", lambda x: F.concat_ws(":", x.k.cast("string"), x.n_name)), ",").alias("rows"))


@query("roster_at", "SELECT c_mktsegment AS program_id, c_custkey AS provider_id, CASE WHEN c_acctbal > 0 THEN 'active' ELSE 'exited' END AS status FROM customer WHERE c_nationkey = 3")
def _(spark, d):
    c = table(spark, d, "customer").select(F.col("c_mktsegment").alias("program_id"), F.col("c_custkey").alias("provider_id"), F.when(F.col("c_acctbal") > 0, "active").otherwise("exited").alias("current_status"), F.concat(F.lit("s"), "c_nationkey").alias("last_seen_snapshot_id"))
    return status.roster_at(c, "s3")


@query("alias_names", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_brand WHEN 1 THEN p_brand || '|' || p_type ELSE '' END AS aliases FROM part")
def _(spark, d):
    text = F.when(F.col("p_partkey") % 3 == 0, F.concat("p_name", F.lit(" (DBA "), "p_brand", F.lit(")"))).when(F.col("p_partkey") % 3 == 1, F.concat("p_name", F.lit(" (d/b/a, "), "p_brand", F.lit(") x (Formerly "), "p_type", F.lit(" )"))).otherwise(F.concat("p_name", F.lit(" (no alias)")))
    return table(spark, d, "part").select("p_partkey", F.array_join(alias_names(text), "|").alias("aliases"))


def _placed(df: DataFrame) -> DataFrame:
    """df with ``place``, the number of each row in the order that it was put in: by partition, and inside each by row."""
    marked = df.withColumn("_id", F.monotonically_increasing_id())
    return marked.withColumn("place", F.row_number().over(Window.orderBy("_id"))).drop("_id")


@query("sort_nulls_last_order", "SELECT c_custkey, row_number() OVER (ORDER BY CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END DESC NULLS LAST, c_custkey)::INTEGER AS place FROM customer")
def _(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal")).alias("balance"))
    return _placed(c.orderBy(F.desc_nulls_last("balance"), "c_custkey")).select("c_custkey", "place")


@query("program_table_order", "SELECT n_name, row_number() OVER (ORDER BY n_regionkey, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey END NULLS LAST, n_name)::INTEGER AS place FROM nation")
def _(spark, d):
    n = table(spark, d, "nation").select("n_name", "n_regionkey", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_nationkey")).alias("launched"))
    return _placed(n.orderBy("n_regionkey", F.asc_nulls_last("launched"), "n_name")).select("n_name", "place")


#: Many updates of a key in one batch, told apart by date and number: the orders of a customer.
UPDATES = """old AS (SELECT c_custkey AS k, c_nationkey AS first, CAST(NULL AS VARCHAR) AS status, c_custkey % 4 = 0 AS verified FROM customer WHERE c_custkey % 3 <> 0),
new AS (SELECT o_custkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey % 100 AS INT) END AS first, o_orderpriority AS status, o_orderkey % 11 = 0 AS verified, o_orderdate AS moment, o_orderkey AS n FROM orders)"""


def _updates(spark, d) -> tuple[DataFrame, DataFrame]:
    old = table(spark, d, "customer").filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("first"), F.lit(None).cast("string").alias("status"), (F.col("c_custkey") % 4 == 0).alias("verified"), F.lit(None).cast("timestamp_ntz").alias("at"), F.lit(None).cast("long").alias("n"))
    n = F.col("o_orderkey")
    return old, table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.when(n % 5 != 0, n % 100).cast("int").alias("first"), F.col("o_orderpriority").alias("status"), (n % 11 == 0).alias("verified"), F.col("o_orderdate").cast("timestamp_ntz").alias("at"), n.alias("n"))


@query("merge_upsert_repeated", f"""WITH {UPDATES}, l AS (SELECT * FROM new QUALIFY row_number() OVER (PARTITION BY k ORDER BY moment DESC, n DESC) = 1)
SELECT k, first, status, verified FROM l UNION ALL SELECT k, first, status, verified FROM old WHERE k NOT IN (SELECT k FROM l)""")
def _(spark, d):
    return merge.merge_upsert(*_updates(spark, d), ["k"], ["at", "n"]).select("k", "first", "status", "verified")


@query("merge_new_repeated", f"""WITH {UPDATES}, l AS (SELECT * FROM new QUALIFY row_number() OVER (PARTITION BY k ORDER BY moment, n) = 1)
SELECT k, first, status FROM old UNION ALL SELECT k, first, status FROM l WHERE k NOT IN (SELECT k FROM old)""")
def _(spark, d):
    return merge.merge_insert_new(*_updates(spark, d), ["k"], ["at", "n"]).select("k", "first", "status")


@query("merge_first_seen_repeated", f"""WITH {UPDATES}, l AS (SELECT k, min_by(first, (moment, n)) FILTER (WHERE first IS NOT NULL) AS first, max_by(status, (moment, n)) AS status, min_by(verified, (moment, n)) AS verified FROM new GROUP BY k)
SELECT k, coalesce(old.first, l.first) AS first, CASE WHEN l.k IS NULL THEN old.status ELSE l.status END AS status, CASE WHEN old.k IS NULL THEN l.verified ELSE old.verified END AS verified FROM old FULL JOIN l USING (k)""")
def _(spark, d):
    return merge.merge_first_seen(*_updates(spark, d), ["k"], keep=["first"], frozen=["verified"], order=["at", "n"]).select("k", "first", "status", "verified")


@query("merge_verified_repeated", f"""WITH {UPDATES}, l AS (SELECT * FROM new QUALIFY row_number() OVER (PARTITION BY k ORDER BY verified DESC, CASE WHEN verified THEN moment END, CASE WHEN verified THEN n END, moment DESC, n DESC) = 1)
SELECT k, CASE WHEN l.k IS NULL OR coalesce(old.verified, false) THEN old.status ELSE l.status END AS status, CASE WHEN l.k IS NULL OR coalesce(old.verified, false) THEN old.verified ELSE l.verified END AS verified FROM old FULL JOIN l USING (k)""")
def _(spark, d):
    return merge.merge_verified(*_updates(spark, d), ["k"], order=["at", "n"]).select("k", "status", "verified")


@query("signals_applied", """WITH t AS (SELECT o_custkey AS k, o_totalprice / 500000 AS c, 's' || o_orderkey AS s, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) END AS d, 'u' || o_orderkey AS u FROM orders
  WHERE o_orderkey % 2 = 0 AND o_totalprice / 500000 >= 0.5 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1)
SELECT c_custkey AS program_id, coalesce(s, 'active') AS program_status, coalesce(d, DATE '2020-01-01') AS sunset_date, coalesce(u, c_name) AS source_url FROM customer LEFT JOIN t ON k = c_custkey""")
def _(spark, d):
    programs = table(spark, d, "customer").select(F.col("c_custkey").alias("program_id"), F.lit("active").alias("program_status"), F.lit("2020-01-01").cast("date").alias("sunset_date"), F.col("c_name").alias("source_url"))
    n = F.col("o_orderkey")
    signals = table(spark, d, "orders").select(
        F.col("o_custkey").alias("program_id"), (n % 2 == 0).alias("is_change"), (F.col("o_totalprice") / 500000).alias("confidence"), F.concat(F.lit("s"), n).alias("proposed_status"),
        F.when(n % 3 == 0, F.to_date("o_orderdate")).alias("proposed_sunset"), F.concat(F.lit("u"), n).alias("source_url"),
    )
    return merge.apply_signals(programs, signals)


@query("label_counter_order", """WITH n AS (SELECT o_orderpriority AS label, count(*) AS n FROM orders GROUP BY 1) SELECT label, n, row_number() OVER (ORDER BY n DESC, label)::INTEGER AS place FROM n""")
def _(spark, d):
    return _placed(counts.label_counts(table(spark, d, "orders"), F.col("o_orderpriority"))).select("label", "n", "place")

"""Rows out of nested JSON: keyed objects, bill records, capture indices, map features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BILLS = (
    "results array<struct<id:string,identifier:string,title:string,session:string,jurisdiction:struct<id:string,name:string>,"
    "latest_action_description:string,latest_action_date:string,actions:array<struct<classification:array<string>>>,abstracts:array<struct<abstract:string>>>>"
)


def explode_keyed_json(df: DataFrame, col: str, skip: Sequence[str], schema: str, id_field: str | None = None) -> DataFrame:
    """One row for each value of a JSON object that is an object itself; keys in ``skip`` and blank ids are dropped."""
    others = [c for c in df.columns if c != col]
    rows = df.select(*others, F.explode(F.from_json(col, "map<string,string>")).alias("key", "_v")).filter(~F.col("key").isin(list(skip)) if skip else F.lit(True))
    rows = rows.filter(F.ltrim("_v").startswith("{")).withColumn("item", F.from_json("_v", schema)).drop("_v")
    return rows if id_field is None else rows.filter(F.coalesce(F.trim(F.col("item")[id_field].cast("string")), F.lit("")) != "")


def explode_bills(df: DataFrame, col: str) -> DataFrame:
    """Bills of a search result: all classes of their actions in one array, the first abstract, the state's code."""
    from ..functions.parse import region_code, tolerant_date

    b = F.col("b")
    return df.select(F.explode(F.from_json(col, BILLS)["results"]).alias("b")).select(
        b.id.alias("bill_id"), b.identifier.alias("identifier"), b.title.alias("title"), b.session.alias("session"), region_code(b.jurisdiction.id).alias("state"),
        F.coalesce(b.latest_action_description, F.lit("")).alias("latest_action"), tolerant_date(b.latest_action_date).alias("action_date"),
        F.coalesce(F.flatten(F.transform(b.actions, lambda a: a.classification)), F.array().cast("array<string>")).alias("classes"), F.get(b.abstracts, F.lit(0)).abstract.alias("abstract"),
    )


def parse_capture_index(df: DataFrame, col: str) -> DataFrame:
    """Captures of an index (array of arrays, the first a header): four cells or more, status 200, time as UTC."""
    rows = df.select(*[c for c in df.columns if c != col], F.posexplode(F.from_json(col, "array<array<string>>")).alias("_n", "r")).filter("_n > 0 and size(r) >= 4")
    rows = rows.filter(F.try_cast(F.col("r")[2], "int") == 200) if hasattr(F, "try_cast") else rows.filter(F.expr("try_cast(r[2] as int) = 200"))
    return rows.select(*[c for c in df.columns if c != col], F.try_to_timestamp(F.col("r")[0], F.lit("yyyyMMddHHmmss")).alias("captured_at"), F.col("r")[1].alias("url"), F.col("r")[3].alias("digest")).filter("captured_at is not null")


def explode_geojson(df: DataFrame, col: str, skip: Sequence[str] = ()) -> DataFrame:
    """Points (shape, ring, pos, lon, lat) of the features of map JSON, polygons and multi-polygons alike."""
    features = "features array<struct<properties:struct<name:string>,geometry:struct<type:string,coordinates:string>>>"
    f = df.select(F.explode(F.from_json(col, features)["features"]).alias("f")).select(F.col("f.properties.name").alias("shape"), F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("c"))
    f = f.filter(~F.col("shape").isin(list(skip))) if skip else f
    polys = F.when(F.col("kind") == "MultiPolygon", F.from_json("c", "array<array<array<array<double>>>>")).otherwise(F.array(F.from_json("c", "array<array<array<double>>>")))
    rings = f.select("shape", F.posexplode(F.flatten(polys)).alias("ring", "points"))
    return rings.select("shape", "ring", F.posexplode("points").alias("pos", "p")).select("shape", "ring", "pos", F.col("p")[0].alias("lon"), F.col("p")[1].alias("lat"))

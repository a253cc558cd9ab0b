import json

from pyspark.sql import functions as F

from rosterline.operators import package
from rosterline.sources.schemas import TABLES, Table

A = Table("k string, area string, n double", ("k",), ("k", "area"), {}, {"area": "^[A-Z]{2}$"}, {}, {"n": (0.0, 1.0)})
B = Table("k string, x int, a string", ("k", "x"), ("k",), {"a": "a"}, values={"k": ("p", "q")})


def test_schema_text(spark):
    got = package.table_schema(TABLES["provider"])
    fields = {f["name"]: f for f in got["fields"]}
    assert got["primaryKey"] == ["provider_id"] and fields["provider_id"]["constraints"] == {"required": True, "unique": True}
    assert fields["jurisdiction"]["constraints"] == {"pattern": "^[A-Z]{2}$"} and "constraints" not in fields["website"] and fields["provider_type"]["constraints"]["enum"] == ["entity", "individual"]
    assert {"fields": "program_id", "reference": {"resource": "program"}} in got["foreignKeys"]
    assert package.table_schema(TABLES["crosswalk"])["fields"][3]["constraints"] == {"required": True, "minimum": 0.0, "maximum": 1.0} and json.dumps(got)


def test_breaches(spark):
    a = spark.createDataFrame([("1", "AZ", 0.5), ("2", "az", 2.0), ("2", None, None), (None, "UT", -1.0), (None, "UT", 1.0)], A.columns)
    b = spark.createDataFrame([("p", 1, "1"), ("p", 1, "9"), ("p", 1, "9"), ("z", 2, None), ("q", None, "2"), ("q", None, "2")], B.columns)
    got = {(x["table_name"], x["check"]): x["n"] for x in package.check_package({"a": a, "b": b, "other": a}, {"a": A, "b": B}).collect()}
    assert got == {
        ("a", "k: required"): 2, ("a", "area: required"): 1, ("a", "area: pattern"): 1, ("a", "n: range"): 2, ("a", "key: repeated"): 2,
        ("b", "k: value"): 1, ("b", "key: repeated"): 3, ("b", "a: no parent"): 2,
    }
    clean = a.limit(1)
    assert package.check_package({"a": clean, "b": b.filter("x = 1 and a = '1'")}, {"a": A, "b": B}).isEmpty()
    assert {x["check"] for x in package.check_package({"a": clean.select("k"), "b": b.limit(1).select("k", "x", "a")}, {"a": A, "b": B}).collect()} == {"area: missing"}
    assert package.check_package({"a": a.limit(0)}, {"a": A}).isEmpty()


def test_describe(spark):
    df = spark.range(50_000).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("A"), F.col("id") % 4)).alias("area"), F.lit(0.5).alias("n"))
    x = package.describe({"a": df, "u": df.select("k")}, {"a": A}, "area").orderBy("table_name").collect()
    assert (x[0]["n_rows"], x[0]["n_columns"], x[0]["n_places"], x[0]["n_nulls"], x[1]["n_places"]) == (50_000, 3, 2, {"k": 0, "area": 25_000, "n": 0}, None)
    assert x[0]["n_distinct"]["area"] == 2 and x[0]["n_distinct"]["n"] == 1 and abs(x[0]["n_distinct"]["k"] - 50_000) < 3_000
    assert json.loads(x[0]["schema"])["primaryKey"] == ["k"]

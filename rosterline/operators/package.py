"""What a package of tables promises, and which rows break it."""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import Table
from .quality import table_rules


def table_schema(table: Table) -> dict:
    """A declared table's fields with their types and constraints, its key, and the tables that it refers to."""
    fields = []
    for f in table.schema:
        limits: dict = {}
        if f.name in table.required:
            limits["required"] = True
        if f.name in table.values:
            limits["enum"] = list(table.values[f.name])
        if f.name in table.patterns:
            limits["pattern"] = table.patterns[f.name]
        if f.name in table.ranges:
            limits["minimum"], limits["maximum"] = table.ranges[f.name]
        if table.key == (f.name,):
            limits["unique"] = True
        fields.append({"name": f.name, "type": f.dataType.simpleString()} | ({"constraints": limits} if limits else {}))
    parents = [{"fields": column, "reference": {"resource": parent}} for column, parent in table.parents.items()]
    return {"fields": fields, "primaryKey": list(table.key)} | ({"foreignKeys": parents} if parents else {})


def describe(tables: Mapping[str, DataFrame], declared: Mapping[str, Table], place: str = "jurisdiction", sketch: int = 12) -> DataFrame:
    """(table_name, n_rows, n_columns, n_places, n_nulls, n_distinct, schema): one aggregate for each table.

    n_places counts the different values of ``place`` exactly, where the table has it: there are few. n_nulls is a map by
    column, n_distinct one of estimates from sketches of 2^``sketch`` registers, so memory doesn't grow with the values and
    partial sketches are merged; few values are counted exactly. schema is JSON text: with constraints where the table is declared.
    """

    def one(name: str, df: DataFrame) -> DataFrame:
        keep = list(df.columns)
        by_column = lambda agg: F.create_map(*[x for c in keep for x in (F.lit(c), agg(c))])
        places = F.count_distinct(place) if place in keep else F.lit(None)
        sums = df.select(*[F.col(c).alias(c) for c in keep], *[F.xxhash64(c).alias(f"_h_{c}") for c in keep]).agg(
            F.count("*").alias("n_rows"), places.cast("long").alias("n_places"), by_column(lambda c: F.count_if(F.col(c).isNull())).alias("n_nulls"),
            by_column(lambda c: F.hll_sketch_estimate(F.hll_sketch_agg(F.when(F.col(c).isNotNull(), F.col(f"_h_{c}")), sketch))).alias("n_distinct"),
        )
        schema = json.dumps(table_schema(declared[name])) if name in declared else df.schema.json()
        return sums.select(F.lit(name).alias("table_name"), "n_rows", F.lit(len(keep)).alias("n_columns"), "n_places", "n_nulls", "n_distinct", F.lit(schema).alias("schema"))

    return reduce(DataFrame.unionByName, [one(name, df) for name, df in tables.items()])


def repeated_keys(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """(key columns, n) of keys that several rows have; a key with a null is looked at as it is.

    Rows are counted by a 64-bit hash of their key, which is all that is shuffled of most of them; only those whose hash
    comes again are counted by the key itself.
    """
    again = df.select(F.xxhash64(*key, *[F.col(c).isNull() for c in key]).alias("_h")).groupBy("_h").agg(F.count("*").alias("n")).filter("n > 1").select("_h")
    own = df.select(*key, F.xxhash64(*key, *[F.col(c).isNull() for c in key]).alias("_h")).join(again, "_h", "left_semi")
    return own.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def check_package(tables: Mapping[str, DataFrame], declared: Mapping[str, Table]) -> DataFrame:
    """(table_name, check, n) of all that breaks the declarations: rows by rule, repeated keys, references without a parent.

    Checks are named ``column: required``, ``pattern``, ``value``, ``range``, ``missing`` (the table lacks a required column), ``key: repeated``
    (rows beyond the first of their key) and ``column: no parent``. All rules of a table are one aggregate. References are
    counted by value before they are looked up, so a value that most rows have is one row for each task. Null references are
    no breach; a parent that isn't in the package has no rows. An empty result passes.
    """
    out = []
    for name, df in tables.items():
        table = declared.get(name)
        if table is None:
            continue
        spark, here = df.sparkSession, set(df.columns)
        rules = table_rules(table, df.columns)
        if rules:
            labels = F.array(*[F.struct(F.lit(label).alias("check"), F.count_if(~F.coalesce(ok, F.lit(True))).alias("n")) for label, ok in rules.items()])
            out.append(df.agg(labels.alias("x")).select(F.explode("x").alias("x")).select(F.lit(name).alias("table_name"), "x.check", "x.n").filter("n > 0"))
        lacking = [(name, f"{c}: missing", 1) for c in table.required if c not in here]
        if lacking:
            out.append(spark.createDataFrame(lacking, "table_name string, check string, n long"))
        if set(table.key) <= here:
            out.append(repeated_keys(df, table.key).agg(F.sum(F.col("n") - 1).alias("n")).filter("n is not null").select(F.lit(name).alias("table_name"), F.lit("key: repeated").alias("check"), "n"))
        for column, parent in table.parents.items():
            if column not in here:
                continue
            counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_v")).agg(F.count("*").alias("n"))
            if parent in tables:
                counts = counts.join(tables[parent].select(F.col(declared[parent].key[0]).alias("_v")), "_v", "left_anti")
            out.append(counts.agg(F.sum("n").alias("n")).filter("n is not null").select(F.lit(name).alias("table_name"), F.lit(f"{column}: no parent").alias("check"), "n"))
    return reduce(DataFrame.unionByName, out)

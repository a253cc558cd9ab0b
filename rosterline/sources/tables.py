"""Tables on disk, and the views of a roster that the queries take from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def load_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table with its declared columns; only those are read."""
    return spark.read.schema(schema).parquet(path) if schema is not None else spark.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def roster_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(program_id, snap_date, provider_id, status): users seen on a day in a kind of event, with the band of the day's last value."""
    last = F.max_by("value", F.struct("ts", "event_id"))
    days = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("program_id"), F.to_date("ts").alias("snap_date"), F.col("user_id").alias("provider_id")).agg(last.alias("v"))
    return days.select("program_id", "snap_date", "provider_id", F.when(F.col("v") < 50, "suspended").when(F.col("v") < 150, "active").otherwise("exited").alias("status"))


def snapshots(observations: DataFrame) -> DataFrame:
    """(program_id, snap_date, snapshot_id, seq) of each program's captures in order of time."""
    text = F.concat_ws("|", "program_id", F.col("snap_date").cast("string"))
    distinct = observations.select("program_id", "snap_date").distinct()
    seq = F.row_number().over(Window.partitionBy("program_id").orderBy("snap_date"))
    return distinct.select("program_id", "snap_date", F.concat(F.lit("snap_"), F.substring(F.sha2(text, 256), 1, 16)).alias("snapshot_id"), seq.alias("seq"))


def monthly_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long chain: customers with orders in a month, with the status of the month's last order."""
    last = F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey"))
    return table(spark, sf_dir, "orders").groupBy(F.lit("orders").alias("program_id"), F.trunc(F.to_date("o_orderdate"), "month").alias("snap_date"), F.col("o_custkey").alias("provider_id")).agg(last.alias("status"))

"""Manifest, ledger and blob files, and releases in Parquet, CSV and JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

MANIFEST = "program_id string, snapshot_id string, source_url string, retrieved_at string, content_sha256 string, storage_path string, media_type string, scraper_version string"
LEDGER = "item string, jurisdiction string, classification string, source_url string, proposed_action string, resolved string, detected_by string, detected_at string"
LEDGER_KEY = ("item", "jurisdiction", "detected_by")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Captures with their time as a timestamp (UTC where the text has no offset) and their order within the program."""
    rows = spark.read.csv(path, header=True, schema=MANIFEST).withColumn("retrieved_at", F.try_to_timestamp("retrieved_at"))
    return rows.withColumn("seq", F.row_number().over(Window.partitionBy("program_id").orderBy("retrieved_at", "snapshot_id")))


def read_blobs(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path relative to the root, content, sha256) of raw captures."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    tail = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    return files.select(F.regexp_replace("path", f"^.*?{tail}/", "").alias("path"), "content", F.sha2("content", 256).alias("sha256"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The gap ledger, typed; of rows with one key the last stays: of several files the last by name, in a file the last row."""
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    rows = spark.read.csv(path, header=True, schema=LEDGER).withColumn("_n", place)
    last = F.row_number().over(Window.partitionBy(*LEDGER_KEY).orderBy(F.desc("_n")))
    rows = rows.withColumn("_r", last).filter("_r = 1").drop("_r", "_n")
    return rows.withColumn("resolved", F.lower("resolved") == "true").withColumn("detected_at", F.try_to_date("detected_at", "yyyy-MM-dd")).orderBy(*LEDGER_KEY)


def register_captures(captures: DataFrame, content: str, media: Column, order: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """captures with sha256, snapshot_id, storage_path and is_new: the first of its bytes by ``order``, and not among the known
    hashes. ``order`` has to tell captures of the same bytes apart. One row for each hash is joined to them, so bytes that very
    many captures have don't meet in one task."""
    hashed = captures.withColumn("sha256", F.sha2(F.col(content), 256)).withColumn("_at", F.struct(*order))
    first = hashed.groupBy(F.col("sha256").alias("_sha")).agg(F.min("_at").alias("_first"))
    out = hashed.join(first, F.col("sha256").eqNullSafe(F.col("_sha"))).withColumn("is_new", F.col("_at") == F.col("_first")).drop("_at", "_sha", "_first")
    out = out.withColumn("snapshot_id", F.concat(F.lit("snap_"), F.substring("sha256", 1, 16))).withColumn("storage_path", F.concat_ws(".", "sha256", media))
    if known is None:
        return out
    old = known.select(F.col("sha256"), F.lit(True).alias("_old")).distinct()
    return out.join(old, "sha256", "left").withColumn("is_new", F.col("is_new") & F.col("_old").isNull()).drop("_old")


def csv_frame(df: DataFrame) -> DataFrame:
    """Arrays as JSON text, null or empty ones and nulls as ''."""

    def plain(f: T.StructField) -> Column:
        c = F.col(f.name)
        if isinstance(f.dataType, T.ArrayType):
            return F.when(F.coalesce(F.size(c), F.lit(0)) <= 0, "").otherwise(F.to_json(c))
        return F.coalesce(c.cast("string"), F.lit(""))

    return df.select(*[plain(f).alias(f.name) for f in df.schema])


def flat_frame(df: DataFrame) -> DataFrame:
    """Timestamps as UTC ISO text with microseconds, arrays as JSON text ([] for an empty one), nulls as ''."""

    def plain(f: T.StructField) -> Column:
        c = F.col(f.name)
        if isinstance(f.dataType, T.ArrayType):
            c = F.to_json(c)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
        return F.coalesce(c.cast("string"), F.lit(""))

    return df.select(*[plain(f).alias(f.name) for f in df.schema])


def export_tables(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], folder: str) -> dict[str, int]:
    """Write each table in the order of its key as Parquet and CSV; returns the counts of what was written.

    A table is put in order once: its sorted partitions are kept on the executors' disks, and both forms are written from
    them; those of a lost executor are sorted again.
    """
    counts = {}
    for name, df in tables.items():
        ordered = df.orderBy(*keys[name]).persist(StorageLevel.DISK_ONLY)
        ordered.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
        csv_frame(ordered).write.mode("overwrite").csv(f"{folder}/{name}.csv", header=True, emptyValue="")
        ordered.unpersist()
        counts[name] = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}.parquet").count()
    return counts


def describe_package(tables: Mapping[str, DataFrame], place: str = "jurisdiction") -> DataFrame:
    """(table_name, n_rows, n_columns, n_places, schema) of each table; n_places counts the different values of ``place``, where
    the table has it, and schema is JSON text."""

    def one(name: str, df: DataFrame) -> DataFrame:
        places = F.count_distinct(place) if place in df.columns else F.lit(None)
        counts = df.agg(F.count("*").alias("n_rows"), places.cast("long").alias("n_places"))
        return counts.select(F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"), "n_places", F.lit(df.schema.json()).alias("schema"))

    return reduce(DataFrame.unionByName, [one(name, df) for name, df in tables.items()])


def write_bundle(tables: Mapping[str, DataFrame], folder: str, nested: Mapping[str, tuple[str, str]] | None = None) -> None:
    """Tables as JSON files for a viewer. ``nested`` maps a table to (parent, key): its rows become an array in the parent's."""
    nested = nested or {}
    for name, df in tables.items():
        if name in nested:
            continue
        out = df
        for child, (parent, key) in nested.items():
            if parent == name:
                rows = tables[child]
                rest = [c for c in rows.columns if c != key]
                arrays = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*rest))).alias(child))
                out = out.join(arrays, key, "left")
        out.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder}/{name}.json")

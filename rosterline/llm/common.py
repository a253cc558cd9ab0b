"""What several operators share: row identity, white space, staging in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import new_path, remove

#: The white space of the contracts: [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: A null identifier takes part in joins and orders as this value.
NULL_ID = -(2**63)


def ident(col: str | Column) -> Column:
    """The identifier with null replaced, so that it can be a join key."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col.cast("long"), F.lit(NULL_ID))


def unident(col: str | Column) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.when(col != NULL_ID, col)


def ascii_lower(col: Column) -> Column:
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(col: Column) -> Column:
    """Maximal runs of other characters than white space, in order."""
    return F.filter(F.split(col, "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")


def n_words(col: Column) -> Column:
    """The number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it again: this cuts the lineage, and lost executors cost nothing."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def numbered(rows: DataFrame, keys: list[str], name: str, parts: int = 1024) -> DataFrame:
    """rows with a number among those that are equal in ``keys`` (no nulls): 0, 1, 2, ... in any order; a row alone has 0.

    Only rows that have an equal one are moved. They are written once with their places and ranked in ``parts`` parts by
    those, so a row that a third of all rows equal is ranked in that many tasks.
    """
    often = staged(rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").select(*keys), "often")
    alone = rows.join(often, keys, "left_anti").withColumn(name, F.lit(0).cast("long"))
    if often.isEmpty():
        return alone
    place = F.monotonically_increasing_id()
    again = staged(rows.join(often, keys, "left_semi").withColumn("_place", place), "again").withColumn("_part", F.pmod("_place", F.lit(parts)))
    sizes = again.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))
    so_far = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    before = sizes.select(*keys, "_part", F.coalesce(so_far, F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy("_place"))
    counted = again.withColumn("_rank", rank).join(before, [*keys, "_part"]).withColumn(name, F.col("_before") + F.col("_rank") - 1)
    return alone.unionByName(counted.select(*alone.columns))


def release(*tables: DataFrame) -> None:
    """Remove tables that ``staged`` returned and that nothing will read again."""
    for table in tables:
        remove(table.sparkSession, table._staged_at)

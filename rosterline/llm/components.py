"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, staged


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step: each node links its larger (large star) or its smaller neighbours and itself (small star) to its least one."""
    if large:
        near = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        near = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = near.join(least, "u")
    if large:
        moved = moved.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for each node of links (a, b) that isn't the least of its component; root is the least.

    All state stays in tables: a step is a partial minimum by node and a join that has one row a node on one side, so a
    node with very many links is split at run time. A step's table is removed once the next one is written; the result's can be given to ``release``. Nothing but a
    checksum of each step reaches the driver.
    """
    links, seen = staged(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"), None
    while True:
        mark = tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())
        if mark == seen:
            out = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
            out._staged_at = links._staged_at
            return out
        seen, last = mark, links
        links = staged(_star(_star(last, True), False), "links")
        release(last)

"""Map geometry: an equal-area conic projection and its fit to a viewport."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARALLELS, ORIGIN = (29.5, 45.5), (-96.0, 38.0)


def albers(lon: Column, lat: Column, parallels: tuple[float, float] = PARALLELS, origin: tuple[float, float] = ORIGIN) -> tuple[Column, Column]:
    """Albers conic x and y of degrees, y growing downwards."""
    first, second = map(math.radians, parallels)
    n = (math.sin(first) + math.sin(second)) / 2
    c = math.cos(first) ** 2 + 2 * n * math.sin(first)
    base = math.sqrt(c - 2 * n * math.sin(math.radians(origin[1]))) / n
    turn = n * (F.radians(lon) - math.radians(origin[0]))
    radius = F.sqrt(F.lit(c) - 2 * n * F.sin(F.radians(lat))) / n
    return radius * F.sin(turn), radius * F.cos(turn) - base


def fit_viewport(points: DataFrame, width: float = 960.0, height: float = 600.0, pad: float = 20.0) -> DataFrame:
    """points (x, y) with px and py in the viewport: one scale for both axes, from the extent of all points (one row)."""
    extent = points.agg(F.min("x").alias("_x0"), F.max("x").alias("_x1"), F.min("y").alias("_y0"), F.max("y").alias("_y1"))
    scale = F.least((width - 2 * pad) / (F.col("_x1") - F.col("_x0")), (height - 2 * pad) / (F.col("_y1") - F.col("_y0")))
    joined = points.crossJoin(F.broadcast(extent.withColumn("_k", scale)))
    return joined.select(*points.columns, ((F.col("x") - F.col("_x0")) * F.col("_k") + pad).alias("px"), ((F.col("y") - F.col("_y0")) * F.col("_k") + pad).alias("py"))


def ring_paths(points: DataFrame, shape: str = "shape", ring: str = "ring", pos: str = "pos") -> DataFrame:
    """One path string for each shape from fitted points, rings and points in order."""
    point = F.format_string("%.1f,%.1f", "px", "py")
    rings = points.groupBy(shape, ring).agg(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), point.alias("t")))).alias("pts"))
    rings = rings.withColumn("d", F.concat(F.lit("M"), F.array_join(F.transform("pts", lambda x: x.t), "L"), F.lit("Z")))
    return rings.groupBy(shape).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(ring).alias("r"), "d"))), lambda x: x.d), " ").alias("path"))

"""Distance joins by cells of latitude and longitude.

Rows of cells are as high as the radius.  Each row has its own number of columns, at least as wide as the radius
anywhere in it or in the rows beside it, and one column near the poles.  Any two points within the radius differ
by one row or none and, in the left point's row, by one column or none, around the globe; so the right side is
entered into nine cells at most and joined on the cell, and exact distances decide.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import MEAN_RADIUS_M, haversine_m

#: Rows that one task of the join takes of both sides together, a row of the right side once for each of its cells.
ROWS = 200_000


def _height(radius_m: float) -> float:
    """Degrees of latitude of a row; at least a millimetre, so that a radius of 0 joins equal points."""
    return math.degrees(max(radius_m, 1e-3) / MEAN_RADIUS_M) * 1.000001


def _columns(row: Column, radius_m: float) -> Column:
    """Columns of a row."""
    high = _height(radius_m)
    steepest = F.least(F.lit(90.0), (F.abs(row + 0.5) + 1.5) * high)
    share = math.sin(min(math.pi / 2, max(radius_m, 1e-3) / (2 * MEAN_RADIUS_M))) / F.greatest(F.lit(1e-12), F.cos(F.radians(steepest)))
    wide = F.degrees(2 * F.asin(F.least(F.lit(1.0), share))) * 1.000001
    return F.greatest(F.lit(1), F.floor(360 / wide)).cast("bigint")


def _column(lon: Column, row: Column, radius_m: float) -> Column:
    n = _columns(row, radius_m)
    return F.least(n - 1, F.floor(F.pmod(lon + 180, F.lit(360.0)) / 360 * n))


def pairs_within(left: DataFrame, right: DataFrame, radius_m: float) -> DataFrame:
    """Every pair at most ``radius_m`` apart (inclusive): structs l and r of both rows, and dist.  Both need lon and lat in degrees; rows without go."""
    row = lambda lat: F.floor(lat / _height(radius_m))
    place = "lon is not null and lat is not null"
    a = left.where(place).select(F.struct("*").alias("l"), row(F.col("lat")).alias("cy"), _column(F.col("lon"), row(F.col("lat")), radius_m).alias("cx"))
    rows = right.where(place).select(F.struct("*").alias("r"), F.explode(F.array(*(row(F.col("lat")) + i for i in (-1, 0, 1)))).alias("cy"))
    n, x = _columns(F.col("cy"), radius_m), _column(F.col("r.lon"), F.col("cy"), radius_m)
    b = rows.select("r", "cy", F.explode(F.array_distinct(F.array(*(F.pmod(x + i, n) for i in (-1, 0, 1))))).alias("cx"))
    dist = haversine_m(F.col("l.lon"), F.col("l.lat"), F.col("r.lon"), F.col("r.lat"))
    # Dealt out by rows, as partitions of so many packed bytes are far larger once a task sorts them.
    parts = max(1, -(-(left.where(place).count() + 9 * right.where(place).count()) // ROWS))
    a, b = (df.repartition(parts, "cx", "cy") for df in (a, b))
    return a.join(b, ["cx", "cy"]).select("l", "r", dist.alias("dist")).where(F.col("dist") <= radius_m)


def exists_within(left: DataFrame, right: DataFrame, radius_m: float, id_col: str = "id") -> DataFrame:
    """Rows of ``left`` with a row of ``right`` within the radius; ``id_col`` is unique."""
    # Points on one spot are one: a crowded spot makes no pairs of its own.
    spots = left.select("lon", "lat").distinct()
    hits = pairs_within(spots, right.select("lon", "lat").distinct(), radius_m).select("l.lon", "l.lat").distinct()
    return left.join(hits, ["lon", "lat"], "left_semi").select(*left.columns)


def max_score_within(left: DataFrame, right: DataFrame, radius_m: float, id_col: str = "id") -> DataFrame:
    """``left`` with best: the highest score of ``right`` within the radius, 0.0 if there is none."""
    spots = right.groupBy("lon", "lat").agg(F.max("score").alias("score"))
    best = pairs_within(left.select("lon", "lat").distinct(), spots, radius_m).groupBy("l.lon", "l.lat").agg(F.max("r.score").alias("best"))
    return left.join(best, ["lon", "lat"], "left").withColumn("best", F.coalesce("best", F.lit(0.0))).select(*left.columns, "best")


def fired_in_own_window(points: DataFrame, dets: DataFrame, radius_m: float, id_col: str = "id") -> DataFrame:
    """``points`` with fired and best over the detections of their own window only (dets has ``id_col``)."""
    d = dets.select(F.col(id_col), F.col("lon").alias("_lon"), F.col("lat").alias("_lat"), F.col("score").alias("_score"))
    near = haversine_m(F.col("lon"), F.col("lat"), F.col("_lon"), F.col("_lat")) <= radius_m
    joined = points.join(d, id_col, "left").groupBy(*points.columns).agg(F.coalesce(F.bool_or(near), F.lit(False)).alias("fired"), F.coalesce(F.max(F.when(near, F.col("_score"))), F.lit(0.0)).alias("best"))
    return joined

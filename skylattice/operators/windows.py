"""Tiles, windows and polygons."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import TILE_PX, WINDOW_PX, ZOOM, global_px, ring_area, tile_of
from ._rows import checkpointed
from .cover import cover, points_inside, windows_inside


def tiles_in_bbox(boxes: DataFrame, zoom: int = ZOOM) -> DataFrame:
    """``boxes`` (w, s, e, n, ...) exploded to their tiles x, y."""
    x0, y0 = tile_of(F.col("w"), F.col("n"), zoom)
    x1, y1 = tile_of(F.col("e"), F.col("s"), zoom)
    return boxes.withColumn("x", F.explode(F.sequence(x0, x1))).withColumn("y", F.explode(F.sequence(y0, y1)))


def with_origin(points: DataFrame, zoom: int = ZOOM, px: int = WINDOW_PX) -> DataFrame:
    """``points`` (lon, lat) with the unrounded pixel origin ogx, ogy of the window round each."""
    gx, gy = global_px(F.col("lon"), F.col("lat"), zoom)
    return points.withColumns({"ogx": gx - px / 2, "ogy": gy - px / 2})


def window_tiles(points: DataFrame, zoom: int = ZOOM, px: int = WINDOW_PX) -> DataFrame:
    """The windows of ``points`` exploded to the tiles x, y that they touch."""
    axis = lambda o: F.sequence(F.floor(F.col(o) / TILE_PX), F.floor((F.col(o) + px - 1) / TILE_PX))
    return with_origin(points, zoom, px).withColumn("x", F.explode(axis("ogx"))).withColumn("y", F.explode(axis("ogy")))


def _identified(polygons: DataFrame) -> DataFrame:
    """``polygons`` with a unique ``id``, which stays the same however often they are read."""
    return checkpointed(polygons.withColumn("id", F.monotonically_increasing_id()))


def windows_over_polygon(polygons: DataFrame, zoom: int = ZOOM, px: int = WINDOW_PX, overlap: float = 0.2) -> DataFrame:
    """Window centres strictly inside ``polygons`` (ring, ...), on a grid from the north-west corner of the bounds: by iy, ix; lon, lat.

    A centre has its polygon's other columns, and ``polygon``, a hash of its ring.
    """
    known = _identified(polygons.drop("id"))
    found = windows_inside(known, cover(known), zoom, px, overlap)
    return found.join(known.withColumn("polygon", F.xxhash64("ring")).drop("ring"), "id").drop("id")


def points_in_polygon(points: DataFrame, polygons: DataFrame) -> DataFrame:
    """``points`` strictly inside any polygon of ``polygons`` (ring), each once."""
    return points_inside(points, cover(_identified(polygons.select("ring"))))


def bounds_of(points: DataFrame, *keys: str) -> DataFrame:
    """(keys, w, s, e, n) of each group of ``points`` (lon, lat)."""
    return points.groupBy(*keys).agg(F.min("lon").alias("w"), F.min("lat").alias("s"), F.max("lon").alias("e"), F.max("lat").alias("n"))


Point = tuple[float, float]


def noded(ways: list[list[Point]]) -> set[tuple[Point, Point]]:
    """The ways' segments, cut where two of them meet or cross; each once, lower end first."""
    segments = {(min(a, b), max(a, b)) for w in ways for a, b in zip(w, w[1:]) if a != b}
    cuts: dict[tuple[Point, Point], set[Point]] = {s: set(s) for s in segments}
    by_x = sorted(segments)
    for i, (a, b) in enumerate(by_x):
        for c, d in by_x[i + 1 :]:
            if c[0] > b[0]:
                break
            if max(a[1], b[1]) < min(c[1], d[1]) or max(c[1], d[1]) < min(a[1], b[1]):
                continue
            for p in _meeting(a, b, c, d):
                cuts[a, b].add(p)
                cuts[c, d].add(p)
    return {(p, q) for (a, b), on in cuts.items() for p, q in zip(sorted(on), sorted(on)[1:])}


def _meeting(a: Point, b: Point, c: Point, d: Point) -> list[Point]:
    """Where two segments meet: their crossing, or the ends of one that lie on the other."""
    cross = lambda o, p, q: (p[0] - o[0]) * (q[1] - o[1]) - (p[1] - o[1]) * (q[0] - o[0])
    on = lambda p, s, t: cross(s, t, p) == 0 and min(s, t) <= p <= max(s, t)
    ends = [p for p, s, t in ((a, c, d), (b, c, d), (c, a, b), (d, a, b)) if on(p, s, t)]
    if ends:
        return ends
    if (cross(a, b, c) > 0) == (cross(a, b, d) > 0) or (cross(c, d, a) > 0) == (cross(c, d, b) > 0):
        return []
    t = cross(c, d, a) / (cross(c, d, a) - cross(c, d, b))
    return [(a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1]))]


def faces(ways: list[list[Point]]) -> list[list[Point]]:
    """Outlines of the bounded faces that the ways enclose, by walking the planar graph's edges with the face on the left; dangling ends go."""
    around: dict[Point, list[Point]] = {}
    for p, q in noded(ways):
        around.setdefault(p, []).append(q)
        around.setdefault(q, []).append(p)
    loose = [p for p, qs in around.items() if len(qs) == 1]
    while loose:
        p = loose.pop()
        if p in around and len(around[p]) == 1:
            q = around.pop(p)[0]
            around[q].remove(p)
            if len(around[q]) == 1:
                loose.append(q)
            elif not around[q]:
                del around[q]
    for p, qs in around.items():
        qs.sort(key=lambda q: math.atan2(q[1] - p[1], q[0] - p[0]))
    left = {(p, q) for p, qs in around.items() for q in qs}
    out = []
    while left:
        start = edge = min(left)
        ring = []
        while True:
            left.discard(edge)
            ring.append(edge[0])
            p, q = edge
            turn = around[q]
            edge = (q, turn[turn.index(p) - 1])
            if edge == start:
                break
        if sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, [*ring[1:], ring[0]])) > 0:
            out.append([*ring, ring[0]])
    return out


def ways_to_polygons(ways: DataFrame) -> DataFrame:
    """(rel_ord, ring): the face of largest planar area that each relation's ways (rel_ord, way_ord, geometry) enclose; a relation whose ways close nothing fails the query.

    A relation is one boundary, so its ways fit one task.
    """
    grouped = ways.groupBy("rel_ord").agg(F.transform(F.array_sort(F.collect_list(F.struct("way_ord", "geometry"))), lambda w: w["geometry"]).alias("ways"))
    point = pa.struct([("lon", pa.float64()), ("lat", pa.float64())])

    @F.arrow_udf("array<array<struct<lon:double,lat:double>>>")
    def enclosed(column: pa.Array) -> pa.Array:
        found = [faces([[(p["lon"], p["lat"]) for p in w] for w in ws]) for ws in column.to_pylist()]
        return pa.array([[[{"lon": x, "lat": y} for x, y in ring] for ring in rings] for rings in found], pa.list_(pa.list_(point)))

    rings = grouped.select("rel_ord", enclosed("ways").alias("rings"))
    checked = rings.select("rel_ord", F.when(F.size("rings") > 0, F.col("rings")).otherwise(F.raise_error(F.concat(F.lit("no closed boundary in relation "), F.col("rel_ord").cast("string")))).alias("rings"))
    largest = checked.select("rel_ord", F.posexplode("rings").alias("at", "ring")).withColumn("area", ring_area(F.col("ring")))
    return largest.groupBy("rel_ord").agg(F.max_by("ring", F.struct("area", -F.col("at"))).alias("ring"))

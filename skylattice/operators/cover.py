"""Polygons prepared as a hierarchy of cells: inside, outside, or on the edge with the edges that meet them.

Cells halve twice from level to level on a grid that all polygons share, so a point finds its cells by equi-joins.  A
cell that many edges meet is cut into sixteen, level by level; a cell that none meets is inside or outside as a whole.
In the others a point is tested against the cell's own edges alone, with the very comparisons of a test against all:

* Edges that don't meet a cell pass it on the left or on the right at every height of its strip.
* How many pass on the right changes within the strip only at a vertex where a ring leaves the cell's own edges, so a
  vertical ray from each such vertex takes the rest of the ring's place, up to one parity that the cell keeps.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import WINDOW_PX, ZOOM, global_px, px_to_lonlat, ring_bounds
from ._rows import checkpointed

#: Degrees of a cell of level 0 (a power of two, so that cell borders are exact), the finest level, and the edges beyond which a cell is cut.
WORLD, FINEST, EDGES = 512.0, 13, 32

#: Stands for the right end of the world in rays.
_FAR = 1e6

_EDGE = ("k", "n", "x0", "y0", "x1", "y1", "ray")


def _size(level: Column) -> Column:
    return F.lit(WORLD) / F.pow(F.lit(4.0), level)


def _crosses(y: Column, e: Column | None = None) -> Column:
    at = (lambda c: F.col(c)) if e is None else (lambda c: e[c])
    return (at("y0") > y) != (at("y1") > y)


def _crossing(y: Column, e: Column | None = None) -> Column:
    at = (lambda c: F.col(c)) if e is None else (lambda c: e[c])
    return (at("x1") - at("x0")) * (y - at("y0")) / F.nullif(at("y1") - at("y0"), F.lit(0.0)) + at("x0")


def _edges(polygons: DataFrame) -> DataFrame:
    """The edges of all rings with the cells of the first level, whose size is about a quarter of the polygon's extent."""
    whole = polygons.where(F.coalesce(F.size("ring") > 0, F.lit(False)) & ~F.exists("ring", lambda p: p.isNull() | p["lon"].isNull() | p["lat"].isNull()))
    b = whole.select("id", "ring", ring_bounds(F.col("ring")).alias("b"))
    extent = F.greatest(F.col("b.e") - F.col("b.w"), F.col("b.n") - F.col("b.s"), F.lit(WORLD / 4.0**FINEST))
    placed = b.withColumn("level", F.greatest(F.lit(0), F.least(F.lit(FINEST), F.ceil(F.log(WORLD / extent) / math.log(4.0)))).cast("int"))
    cell = lambda v: F.floor(F.col(v) / _size(F.col("level")))
    placed = placed.select("id", "ring", F.lit(0).alias("odd"), "level", cell("b.w").alias("ax"), cell("b.e").alias("bx"), cell("b.s").alias("ay"), cell("b.n").alias("by"))
    at = placed.select("*", F.size("ring").alias("n"), F.posexplode("ring").alias("k", "p"), F.col("ring").alias("_r"))
    after = F.get("_r", (F.col("k") + 1) % F.col("n"))
    return at.select("id", "odd", "level", "ax", "bx", "ay", "by", "k", "n", F.col("p.lon").alias("x0"), F.col("p.lat").alias("y0"), after["lon"].alias("x1"), after["lat"].alias("y1"), F.lit(False).alias("ray"))


def _step(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells of one level below ``lists``, each (id, level, cx, cy, odd, own), and their edges and rays."""
    size = _size(F.col("level"))
    spread = lists.withColumn("cx", F.explode(F.sequence("ax", "bx"))).withColumn("cy", F.explode(F.sequence("ay", "by")))
    spread = spread.withColumns({"l": F.col("cx") * size, "r": (F.col("cx") + 1) * size, "b": F.col("cy") * size, "t": (F.col("cy") + 1) * size})
    slack, half = size * 1e-6, size / 2
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    apart = F.abs(dx * (F.col("b") + half - F.col("y0")) - dy * (F.col("l") + half - F.col("x0")))
    boxes = (F.greatest("x0", "x1") >= F.col("l") - slack) & (F.least("x0", "x1") <= F.col("r") + slack) & (F.greatest("y0", "y1") >= F.col("b") - slack) & (F.least("y0", "y1") <= F.col("t") + slack)
    spread = spread.withColumn("own", ~F.col("ray") & boxes & (apart <= (F.abs(dx) + F.abs(dy)) * (half + slack)))
    right = ~F.col("own") & _crosses(F.col("b")) & (_crossing(F.col("b")) > F.col("l") + half)
    spread = spread.withColumn("right", F.coalesce(right, F.lit(False)))
    cell = ["id", "level", "cx", "cy"]
    counts = spread.groupBy(*cell, "odd").agg(F.count_if("own").alias("own"), F.count_if("right").alias("passing"))
    own = spread.where("own")
    # Vertices right of the cell, in its strip, that only one of its own edges has.
    ends = own.select(*cell, "l", "r", "b", "t", F.explode(F.array(F.struct(F.col("k").alias("v"), F.col("x0").alias("x"), F.col("y0").alias("y")), F.struct(((F.col("k") + 1) % F.col("n")).alias("v"), F.col("x1").alias("x"), F.col("y1").alias("y")))).alias("e"))
    ends = ends.where((F.col("e.y") >= F.col("b")) & (F.col("e.y") < F.col("t")) & (F.col("e.x") > F.col("r")))
    rays = ends.groupBy(*cell, F.col("e.v").alias("k"), F.col("e.y").alias("y0"), "b").agg(F.count("*").alias("edges")).where("edges = 1")
    level_rays = rays.where(F.col("y0") == F.col("b")).groupBy(*cell).agg(F.count("*").alias("turned"))
    cells = counts.join(level_rays, cell, "left")
    cells = cells.select(*cell, ((F.col("odd") + F.col("passing") + F.coalesce("turned", F.lit(0))) % 2).cast("int").alias("odd"), "own")
    far = rays.select(*cell, "k", F.lit(0).alias("n"), F.lit(_FAR).alias("x0"), "y0", F.lit(_FAR).alias("x1"), F.lit(float("inf")).alias("y1"), F.lit(True).alias("ray"))
    return cells, own.select(*cell, *_EDGE).unionByName(far)


def cover(polygons: DataFrame) -> DataFrame:
    """(id, level, cx, cy, odd, edges) of polygons (id, ring): the cells inside, with null edges, and those on the edge.

    ``id`` is unique; rings are closed or not.  Polygons without points or with a null one have no cells.
    """
    lists, leaves = _edges(polygons), None
    cell = ["id", "level", "cx", "cy"]
    for _ in range(FINEST + 1):
        cells, edges = _step(lists)
        both = checkpointed(edges.join(cells, cell, "right").where("own > 0 or odd = 1"))
        dense = (F.col("own") > EDGES) & (F.col("level") < FINEST)
        listed = F.collect_list(F.when(F.col("own") > 0, F.struct("x0", "y0", "x1", "y1", "ray")))
        done = both.where(~dense).groupBy(*cell, "odd", "own").agg(listed.alias("edges")).select(*cell, "odd", F.when(F.col("own") > 0, F.col("edges")).alias("edges"))
        leaves = done if leaves is None else leaves.unionByName(done)
        rest = both.where(dense)
        if rest.isEmpty():
            break
        quarter = lambda c, i: (F.col(c) * 4 + i).cast("bigint")
        lists = rest.select("id", "odd", (F.col("level") + 1).alias("level"), quarter("cx", 0).alias("ax"), quarter("cx", 3).alias("bx"), quarter("cy", 0).alias("ay"), quarter("cy", 3).alias("by"), *_EDGE)
    return leaves


def inside_cell(lon: Column, lat: Column, odd: Column, edges: Column) -> Column:
    """Whether a point of a cell is strictly inside the cell's polygon: points on an edge don't count."""
    passing = F.size(F.filter(edges, lambda e: _crosses(lat, e) & (lon < _crossing(lat, e))))
    on = lambda e: ~e["ray"] & ((lon - e["x0"]) * (e["y1"] - e["y0"]) == (lat - e["y0"]) * (e["x1"] - e["x0"])) & lon.between(F.least(e["x0"], e["x1"]), F.greatest(e["x0"], e["x1"])) & lat.between(F.least(e["y0"], e["y1"]), F.greatest(e["y0"], e["y1"]))
    return F.when(edges.isNull(), odd == 1).otherwise(((passing + odd) % 2 == 1) & ~F.exists(edges, on))


def _levels(leaves: DataFrame) -> list[int]:
    return sorted(r.level for r in leaves.select("level").distinct().collect())  # FINEST + 1 at most


def points_inside(points: DataFrame, leaves: DataFrame) -> DataFrame:
    """``points`` (lon, lat, ...) strictly inside any covered polygon, each once; points with a null place go."""
    levels = _levels(leaves)
    if not levels:
        return points.limit(0)
    placed = points.select(F.struct("*").alias("_point"), "lon", "lat")
    keys = lambda v, i: F.floor(F.col(v) / (WORLD / 4.0**i)).cast("bigint")
    spread = placed.select("_point", "lon", "lat", F.explode(F.array(*(F.struct(F.lit(i).alias("level"), keys("lon", i).alias("cx"), keys("lat", i).alias("cy")) for i in levels))).alias("_c"))
    left = spread.select("_point", "lon", "lat", "_c.*")
    cells = leaves.select(F.col("level").alias("_l"), F.col("cx").alias("_x"), F.col("cy").alias("_y"), "odd", "edges")
    same = (F.col("level") == F.col("_l")) & (F.col("cx") == F.col("_x")) & (F.col("cy") == F.col("_y"))
    return left.join(cells, same & inside_cell(F.col("lon"), F.col("lat"), F.col("odd"), F.col("edges")), "left_semi").select("_point.*")


def windows_inside(polygons: DataFrame, leaves: DataFrame, zoom: int = ZOOM, px: int = WINDOW_PX, overlap: float = 0.2) -> DataFrame:
    """(id, iy, ix, lon, lat): centres strictly inside, on a grid from the north-west corner of each polygon's bounds.

    Each cell makes the lines of its own part of the grid, these are dealt out, and each line makes its places.
    """
    step = max(1, int(px * (1 - overlap)))
    b = ring_bounds(F.col("ring"))
    corner = dict(zip(("_gx", "_gy"), global_px(b["w"], b["n"], zoom))) | dict(zip(("_ex", "_ey"), global_px(b["e"], b["s"], zoom)))
    grid = polygons.withColumns(corner).select("id", "_gx", "_gy", F.floor((F.col("_ex") - F.col("_gx")) / step).alias("_nx"), F.floor((F.col("_ey") - F.col("_gy")) / step).alias("_ny"))
    size = _size(F.col("level"))
    x0, y1 = global_px(F.col("cx") * size, F.greatest(F.lit(-89.9), F.col("cy") * size), zoom)
    x1, y0 = global_px((F.col("cx") + 1) * size, F.least(F.lit(89.9), (F.col("cy") + 1) * size), zoom)
    first = lambda v, g: F.greatest(F.lit(0), F.floor((v - F.col(g)) / step) - 1)
    last = lambda v, g, n: F.least(F.col(n), F.ceil((v - F.col(g)) / step) + 1)
    ranged = leaves.join(grid, "id").withColumns({"ax": first(x0, "_gx"), "bx": last(x1, "_gx", "_nx"), "ay": first(y0, "_gy"), "by": last(y1, "_gy", "_ny")}).where("ax <= bx and ay <= by")
    lines = ranged.withColumn("iy", F.explode(F.sequence("ay", "by")))
    _, lat = px_to_lonlat(F.lit(0.0), F.col("_gy") + F.col("iy") * step, zoom)
    lines = lines.withColumn("lat", lat).where(F.floor(F.col("lat") / size) == F.col("cy"))
    lines = lines.repartition("id", "iy", "cx", "level")
    places = lines.withColumn("ix", F.explode(F.sequence("ax", "bx")))
    lon, _ = px_to_lonlat(F.col("_gx") + F.col("ix") * step, F.lit(0.0), zoom)
    places = places.withColumn("lon", lon).where(F.floor(F.col("lon") / size) == F.col("cx"))
    return places.where(inside_cell(F.col("lon"), F.col("lat"), F.col("odd"), F.col("edges"))).select("id", "iy", "ix", "lon", "lat")

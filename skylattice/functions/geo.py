"""Web-Mercator and great-circle algebra as Spark columns.

Three Earth models stand side by side on purpose: the mean radius for distances, a fixed number of metres per
degree for boxes, and the Mercator radius for raster grids.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MEAN_RADIUS_M = 6_371_000.0
METRES_PER_DEGREE = 111_320.0
MERCATOR_RADIUS_M = 6_378_137.0
TILE_PX = 256
ZOOM = 19
WINDOW_PX = 640
DEFAULT_BOX_M = 13.0


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres."""
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon) * F.sin(dlon)
    return 2 * MEAN_RADIUS_M * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def world_px(zoom: int = ZOOM) -> float:
    return float(TILE_PX * 2**zoom)


def metres_per_px(zoom: int = ZOOM) -> float:
    return 2 * math.pi * MERCATOR_RADIUS_M / world_px(zoom)


def global_px(lon: Column, lat: Column, zoom: int = ZOOM) -> tuple[Column, Column]:
    """Absolute pixel position (x, y)."""
    n = world_px(zoom)
    return n / 2 * (1 + lon / 180), n / 2 * (1 - F.log(F.tan(F.pi() / 4 + F.radians(lat) / 2)) / F.pi())


def px_to_lonlat(gx: Column, gy: Column, zoom: int = ZOOM) -> tuple[Column, Column]:
    n = world_px(zoom)
    return gx / n * 360 - 180, F.degrees(2 * F.atan(F.exp(F.pi() * (1 - 2 * gy / n))) - F.pi() / 2)


def tile_of(lon: Column, lat: Column, zoom: int = ZOOM) -> tuple[Column, Column]:
    """Slippy tile (x, y)."""
    return tuple(F.floor(g / TILE_PX) for g in global_px(lon, lat, zoom))


def in_tile_px(lon: Column, lat: Column, zoom: int = ZOOM) -> tuple[Column, Column]:
    """Pixel position within the tile."""
    return tuple(g - TILE_PX * F.floor(g / TILE_PX) for g in global_px(lon, lat, zoom))


def tile_px_to_lonlat(x: Column, y: Column, px: Column, py: Column, zoom: int = ZOOM) -> tuple[Column, Column]:
    return px_to_lonlat(x * TILE_PX + px, y * TILE_PX + py, zoom)


def fixed_box(lon: Column, lat: Column, size_m: float = DEFAULT_BOX_M) -> Column:
    """struct<w, s, e, n> of a square of ``size_m`` metres."""
    dlat = F.lit(size_m / 2 / METRES_PER_DEGREE)
    dlon = dlat / F.cos(F.radians(lat))
    return F.struct((lon - dlon).alias("w"), (lat - dlat).alias("s"), (lon + dlon).alias("e"), (lat + dlat).alias("n"))


def ring_bounds(ring: Column) -> Column:
    """struct<w, s, e, n> of an array of points."""
    of = lambda f, k: f(F.transform(ring, lambda p: p[k]))
    return F.struct(of(F.array_min, "lon").alias("w"), of(F.array_min, "lat").alias("s"), of(F.array_max, "lon").alias("e"), of(F.array_max, "lat").alias("n"))


def element_box(kind: Column, lon: Column, lat: Column, geometry: Column, size_m: float = DEFAULT_BOX_M) -> Column:
    """struct<lon, lat, bbox>: a way's bounds and their midpoint, a node's fixed box."""
    b = ring_bounds(geometry)
    way = F.struct(((b["w"] + b["e"]) / 2).alias("lon"), ((b["s"] + b["n"]) / 2).alias("lat"), b.alias("bbox"))
    return F.when(kind == "way", way).otherwise(F.struct(lon.alias("lon"), lat.alias("lat"), fixed_box(lon, lat, size_m).alias("bbox")))


def box_to_px(bbox: Column, ogx: Column, ogy: Column, zoom: int = ZOOM, px: int = WINDOW_PX) -> Column:
    """struct<x0, y0, x1, y1> of a box in a window, clamped to it."""
    x0, y0 = global_px(bbox["w"], bbox["n"], zoom)
    x1, y1 = global_px(bbox["e"], bbox["s"], zoom)
    clamp = lambda v: F.greatest(F.lit(0.0), F.least(F.lit(float(px)), v))
    return F.struct(clamp(x0 - ogx).alias("x0"), clamp(y0 - ogy).alias("y0"), clamp(x1 - ogx).alias("x1"), clamp(y1 - ogy).alias("y1"))


def yolo_label(box: Column, px: int = WINDOW_PX, cls: int = 0, digits: int = 6) -> Column:
    """"cls cx cy w h", normalised to six decimals, or ``digits``; null for a box without area."""
    w, h = box["x1"] - box["x0"], box["y1"] - box["y0"]
    text = F.format_string("%d" + f" %.{digits}f" * 4, F.lit(cls), (box["x0"] + box["x1"]) / 2 / px, (box["y0"] + box["y1"]) / 2 / px, w / px, h / px)
    return F.when((w > 0) & (h > 0), text)


def box_centre_lonlat(cx: Column, cy: Column, ogx: Column, ogy: Column, zoom: int = ZOOM) -> tuple[Column, Column]:
    """Lon/lat of a box centre in a window."""
    return px_to_lonlat(ogx + cx, ogy + cy, zoom)


def ring_area(ring: Column) -> Column:
    """Planar area (shoelace) of a ring of points, closed or not."""
    n = F.size(ring)
    terms = F.transform(ring, lambda p, i: p["lon"] * F.get(ring, (i + 1) % n)["lat"] - F.get(ring, (i + 1) % n)["lon"] * p["lat"])
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)) / 2


def raster_offset(value: Column, origin: Column, resolution: float) -> Column:
    """Whole pixels between two positions, halves to even."""
    return F.bround((value - origin) / resolution).cast("bigint")


def snapped(bounds: Column, resolution: float) -> Column:
    """struct<x0, y0, x1, y1>: bounds on the Mercator pixel grid, floor on the low side and ceiling on the high, y downwards."""
    half = math.pi * MERCATOR_RADIUS_M
    low = lambda v: F.floor(v / resolution).cast("bigint")
    high = lambda v: F.ceil(v / resolution).cast("bigint")
    return F.struct(low(bounds["left"] + half).alias("x0"), low(half - bounds["top"]).alias("y0"), high(bounds["right"] + half).alias("x1"), high(half - bounds["bottom"]).alias("y1"))


def tile_url(x: Column, y: Column, template: str, layer: str, zoom: int = ZOOM) -> Column:
    """``template`` with {layer}, {z}, {x}, {y} filled in."""
    out = F.lit(template.replace("{layer}", layer).replace("{z}", str(zoom)))
    return F.replace(F.replace(out, F.lit("{x}"), x.cast("string")), F.lit("{y}"), y.cast("string"))


def tile_key(x: Column, y: Column, layer: Column, default_layer: str, zoom: int = ZOOM) -> Column:
    """Cache name of a tile; other layers than the default one add the last dotted part of their name."""
    tag = F.when(layer == default_layer, "").otherwise(F.concat(F.lit("_"), F.lower(F.element_at(F.split(layer, r"\."), -1))))
    return F.concat(F.format_string(f"{zoom}_%d_%d", x, y), tag, F.lit(".jpg"))

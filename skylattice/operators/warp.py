"""Rasters of a conic projection warped to tiles of the Mercator grid.

Source rasters come as blocks, so that no row holds a whole raster.  Each block is cut to what every output tile under
it needs, with a margin for interpolation, and only these cuts are shuffled, by tile.  A tile gathers one raster's cuts
after another, samples them between the four nearest pixel centres, and the last raster that isn't zero at a pixel wins
it; where there is none the pixel is 0.  Rasters are taken in steps of ``TOGETHER``, so that a place that very many
rasters cover isn't one task's work.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conic import ARRAYS, LAMBERT_93, Conic, from_mercator, to_mercator
from ..functions.geo import MERCATOR_RADIUS_M, TILE_PX, ZOOM, metres_per_px

#: Source pixels round a tile's outline that its interpolation may touch, rasters that one task lays over each other, cuts in one batch, and bytes of source a task.
MARGIN, TOGETHER, CUTS, TASK_BYTES = 2, 64, 64, 1 << 22

BLOCK = ("ord", "left", "top", "res", "width", "height", "col", "row", "w", "h", "pixels")
_CUT = "x bigint, y bigint, ord bigint, left double, top double, res double, width bigint, height bigint, col bigint, row bigint, w bigint, h bigint, pixels binary"
_CUT_FIELDS = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("ord", pa.int64()), *((k, pa.float64()) for k in ("left", "top", "res")), *((k, pa.int64()) for k in ("width", "height", "col", "row", "w", "h")), ("pixels", pa.binary())])


def _outline(x0: float, y0: float, x1: float, y1: float, n: int = 22) -> tuple[np.ndarray, np.ndarray]:
    """Points on the edges of a box."""
    t = np.linspace(0.0, 1.0, n)
    xs, ys = x0 + (x1 - x0) * t, y0 + (y1 - y0) * t
    return np.concatenate([xs, xs, np.full(n, x0), np.full(n, x1)]), np.concatenate([np.full(n, y0), np.full(n, y1), ys, ys])


def source_px(gx: np.ndarray, gy: np.ndarray, left: float, top: float, res: float, zoom: int, crs: Conic) -> tuple[np.ndarray, np.ndarray]:
    """The column and row in a raster, in pixels from its corner, of places on the Mercator pixel grid."""
    mpp, half = metres_per_px(zoom), math.pi * MERCATOR_RADIUS_M
    east, north = crs.forward(*from_mercator(gx * mpp - half, half - gy * mpp, ARRAYS), ARRAYS)
    return (east - left) / res, (top - north) / res


def grid_px(east: np.ndarray, north: np.ndarray, zoom: int, crs: Conic) -> tuple[np.ndarray, np.ndarray]:
    mpp, half = metres_per_px(zoom), math.pi * MERCATOR_RADIUS_M
    x, y = to_mercator(*crs.inverse(east, north, ARRAYS), ARRAYS)
    return (x + half) / mpp, (half - y) / mpp


def _cuts(block: dict, zoom: int, side: int, bands: int, crs: Conic) -> Iterator[dict]:
    """The parts of a block that the tiles under it need."""
    at = [block[k] for k in BLOCK]
    if any(v is None for v in at) or min(block["w"], block["h"]) <= 0 or len(block["pixels"]) != block["w"] * block["h"] * bands:
        return
    left, top, res, col, row, w, h = (block[k] for k in ("left", "top", "res", "col", "row", "w", "h"))
    pixels = np.frombuffer(block["pixels"], np.uint8).reshape(h, w, bands)
    edge = MARGIN * res
    gx, gy = grid_px(*_outline(left + col * res - edge, top - (row + h) * res - edge, left + (col + w) * res + edge, top - row * res + edge), zoom, crs)
    for x in range(math.floor(gx.min() / side), math.floor(gx.max() / side) + 1):
        for y in range(math.floor(gy.min() / side), math.floor(gy.max() / side) + 1):
            sx, sy = source_px(*_outline(x * side, y * side, (x + 1) * side, (y + 1) * side), left, top, res, zoom, crs)
            c0, c1 = max(col, math.floor(sx.min()) - MARGIN), min(col + w, math.ceil(sx.max()) + MARGIN)
            r0, r1 = max(row, math.floor(sy.min()) - MARGIN), min(row + h, math.ceil(sy.max()) + MARGIN)
            if c0 < c1 and r0 < r1:
                yield {**{k: block[k] for k in ("ord", "left", "top", "res", "width", "height")}, "x": x, "y": y, "col": c0, "row": r0, "w": c1 - c0, "h": r1 - r0, "pixels": pixels[r0 - row : r1 - row, c0 - col : c1 - col].tobytes()}


def sampled(patch: np.ndarray, c0: int, r0: int, width: int, height: int, sx: np.ndarray, sy: np.ndarray) -> np.ndarray:
    """Values between the four nearest pixel centres, rounded; 0 outside the raster, whose edge pixels reach to its edge.

    ``patch`` is the raster's part from column c0 and row r0.
    """
    inside = (sx >= 0) & (sx < width) & (sy >= 0) & (sy < height)
    u, v = sx - 0.5, sy - 0.5
    cu, cv = np.floor(u), np.floor(v)
    fu, fv = (u - cu)[..., None], (v - cv)[..., None]
    column = lambda c: np.clip(np.clip(c, 0, width - 1) - c0, 0, patch.shape[1] - 1).astype(np.int64)
    line = lambda r: np.clip(np.clip(r, 0, height - 1) - r0, 0, patch.shape[0] - 1).astype(np.int64)
    a, b, c, d = (patch[line(r), column(k)].astype(np.float64) for r in (cv, cv + 1) for k in (cu, cu + 1))
    out = np.floor((a * (1 - fu) + b * fu) * (1 - fv) + (c * (1 - fu) + d * fu) * fv + 0.5)
    return np.where(inside[..., None], out, 0).astype(np.uint8)


def _lay_raster(tile: np.ndarray, cuts: list[dict], zoom: int, crs: Conic) -> None:
    """Lays one raster's share, from its cuts, over a tile; places that no cut covers stay."""
    one, side, bands = cuts[0], tile.shape[0], tile.shape[2]
    c0, r0 = min(c["col"] for c in cuts), min(c["row"] for c in cuts)
    c1, r1 = max(c["col"] + c["w"] for c in cuts), max(c["row"] + c["h"] for c in cuts)
    patch = np.zeros((r1 - r0, c1 - c0, bands), np.uint8)
    for c in cuts:
        patch[c["row"] - r0 : c["row"] - r0 + c["h"], c["col"] - c0 : c["col"] - c0 + c["w"]] = np.frombuffer(c["pixels"], np.uint8).reshape(c["h"], c["w"], bands)
    # Only the pixels over the patch are sampled.
    left, top, res = one["left"], one["top"], one["res"]
    gx, gy = grid_px(*_outline(left + c0 * res, top - r1 * res, left + c1 * res, top - r0 * res), zoom, crs)
    (x0, x1), (y0, y1) = (((max(0, math.floor(g.min()) - 1 - at * side), min(side, math.ceil(g.max()) + 1 - at * side)) for g, at in ((gx, one["x"]), (gy, one["y"]))))
    if x0 >= x1 or y0 >= y1:
        return
    gx, gy = np.meshgrid(one["x"] * side + np.arange(x0, x1) + 0.5, one["y"] * side + np.arange(y0, y1) + 0.5)
    sx, sy = source_px(gx, gy, left, top, res, zoom, crs)
    out = sampled(patch, c0, r0, one["width"], one["height"], sx, sy)
    out[(sx < c0) | (sx >= c1) | (sy < r0) | (sy >= r1)] = 0
    lay_over(tile[y0:y1, x0:x1], out)


def lay_over(below: np.ndarray, above: np.ndarray) -> None:
    """Puts ``above`` on ``below`` where any of its bands isn't 0."""
    np.copyto(below, above, where=above.any(axis=-1, keepdims=True))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def _runs(rows: Iterator[dict], *keys: str) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Consecutive rows of equal keys, without holding them."""
    from itertools import groupby

    return groupby(rows, key=lambda r: tuple(r[k] for k in keys))


def warped(blocks: DataFrame, zoom: int = ZOOM, side: int = TILE_PX, bands: int = 3, crs: Conic = LAMBERT_93) -> DataFrame:
    """(x, y, pixels): tiles of ``side`` pixels of the Mercator grid under ``blocks``.

    A block is a rectangle of a raster: ``ord`` (place in the order of rasters), the raster's ``left`` and ``top`` in the
    projection, pixel size ``res`` and ``width`` and ``height`` in pixels, and the block's ``col``, ``row``, ``w``, ``h``
    and ``pixels``, bands interleaved.  Blocks of one raster may have any size; missing ones leave zeros.  Blocks with a
    null field or unreadable pixels are skipped, repeated ones are the same as one.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[dict] = []
        for block in _rows(batches):
            for c in _cuts(block, zoom, side, bands, crs):
                found.append(c)
                if len(found) == CUTS:
                    yield pa.RecordBatch.from_pylist(found, _CUT_FIELDS)
                    found = []
        if found:
            yield pa.RecordBatch.from_pylist(found, _CUT_FIELDS)

    partial = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("step", pa.int64()), ("pixels", pa.binary())])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (x, y, step), rows in _runs(_rows(batches), "x", "y", "step"):
            tile = np.zeros((side, side, bands), np.uint8)
            for _, cuts in _runs(rows, "ord"):
                _lay_raster(tile, list(cuts), zoom, crs)
            yield pa.RecordBatch.from_pylist([{"x": x, "y": y, "step": step, "pixels": tile.tobytes()}], partial)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (x, y), rows in _runs(_rows(batches), "x", "y"):
            tile = np.zeros((side, side, bands), np.uint8)
            for r in rows:
                lay_over(tile, np.frombuffer(r["pixels"], np.uint8).reshape(side, side, bands))
            if tile.any():
                yield pa.RecordBatch.from_pylist([{"x": x, "y": y, "step": None, "pixels": tile.tobytes()}], partial)

    numbers = [F.col(k).cast("double" if k in ("left", "top", "res") else "bigint").alias(k) for k in BLOCK[:-1]]
    cuts = blocks.select(*numbers, "pixels").mapInArrow(cut, _CUT).withColumn("step", F.floor(F.col("ord") / TOGETHER))
    # Packed pixels say little of their size: Spark would put any number of tiles into one task.
    source = blocks.agg(F.sum(F.col("w").cast("bigint") * F.col("h") * bands)).first()[0] or 0
    tasks = max(8, -(-source // TASK_BYTES))
    steps = cuts.repartition(tasks, "x", "y", "step").sortWithinPartitions("x", "y", "step", "ord").mapInArrow(gathered, "x bigint, y bigint, step bigint, pixels binary")
    tiles = steps.repartition(tasks, "x", "y").sortWithinPartitions("x", "y", "step").mapInArrow(merged, "x bigint, y bigint, step bigint, pixels binary")
    return tiles.select("x", "y", "pixels")

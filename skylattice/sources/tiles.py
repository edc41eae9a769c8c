"""A table of raster tiles keyed in Morton order, and window reads from it.

The table is bucketed by its key, so a join with it brings the keys that are sought to the tiles and never moves a tile;
each tile meets all windows that show it at once, and what leaves a bucket is only the part of it that a window shows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.geo import TILE_PX, WINDOW_PX, ZOOM
from ..operators.windows import with_origin

#: Bytes of windows that a task pastes before it hands them on, bytes of windows a task, and bytes of tiles that a reader takes at once, about.
WINDOW_BYTES, TASK_BYTES, READ_BYTES = 1 << 22, 1 << 24, 1 << 24


def morton(x: Column, y: Column) -> Column:
    """The bits of two numbers of at most 31 bits in turn, so that near tiles have near keys."""

    def spread(v: Column) -> Column:
        v = v.cast("bigint")
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return spread(x).bitwiseOR(F.shiftleft(spread(y), 1))


def write_tiles(tiles: DataFrame, table: str, buckets: int = 64) -> None:
    """``tiles`` (x, y, pixels) as a table, each bucket one sorted file; one tile a place."""
    keyed = tiles.select(morton(F.col("x"), F.col("y")).alias("morton"), "x", "y", "pixels")
    keyed.repartition(buckets, "morton").write.mode("overwrite").format("parquet").bucketBy(buckets, "morton").sortBy("morton").option("parquet.block.size", READ_BYTES).saveAsTable(table)


def _shown(side: int, px: int, bands: int, fields: pa.Schema):
    """The part of each tile that each of its windows shows, with its place in the window; a null part where there is none."""

    def shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch["pixels"][i]
                good = raw.is_valid and len(raw.as_buffer()) == side * side * bands
                tile = np.frombuffer(raw.as_buffer(), np.uint8).reshape(side, side, bands) if good else None
                for w in batch["windows"][i].as_py():
                    dx, dy = batch["x"][i].as_py() * side - w["x0"], batch["y"][i].as_py() * side - w["y0"]
                    a, b, c, d = max(0, dx), max(0, dy), min(px, dx + side), min(px, dy + side)
                    some = good and a < c and b < d
                    part = {"dx": a, "dy": b, "w": c - a, "h": d - b, "part": tile[b - dy : d - dy, a - dx : c - dx].tobytes()} if some else None
                    out.append({"id": w["id"], "ogx": w["ogx"], "ogy": w["ogy"], "p": part})
                    size += 64 + (len(part["part"]) if part else 0)
                    if size >= WINDOW_BYTES:
                        yield pa.RecordBatch.from_pylist(out, fields)
                        out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, fields)

    return shown


def _pasted(px: int, bands: int, swap: bool):
    """Windows from their parts, handed on a few at a time: a batch of parts can stand for windows far larger than itself."""
    together = max(1, WINDOW_BYTES // (px * px * bands))

    def pasted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, together):
                some, out = b.slice(i, together), []
                for parts in some["parts"]:
                    window = np.zeros((px, px, bands), np.uint8)
                    for p in parts.as_py() or []:
                        window[p["dy"] : p["dy"] + p["h"], p["dx"] : p["dx"] + p["w"]] = np.frombuffer(p["part"], np.uint8).reshape(p["h"], p["w"], bands)
                    out.append((window[..., ::-1] if swap else window).tobytes())
                yield pa.RecordBatch.from_arrays([*(some[k] for k in ("id", "ogx", "ogy")), pa.array(out, pa.binary())], ["id", "ogx", "ogy", "pixels"])

    return pasted


def read_windows(tiles: DataFrame, points: DataFrame, zoom: int = ZOOM, px: int = WINDOW_PX, side: int = TILE_PX, bands: int = 3, swap: bool = True) -> DataFrame:
    """(id, ogx, ogy, pixels): the window of ``px`` pixels round each of ``points`` (id, lon, lat), from a table of ``write_tiles``.

    It is cut at the rounded origin, halves to even; ogx and ogy are the unrounded one.  Where there is no tile it is 0.
    ``swap`` turns the order of the bands, as tiles are red first and windows blue first.  Equal points give one window;
    points with a null place go.
    """
    placed = with_origin(points.where("lon is not null and lat is not null"), zoom, px).select("id", "ogx", "ogy").distinct()
    x0, y0 = F.bround("ogx").cast("bigint"), F.bround("ogy").cast("bigint")
    axis = lambda o: F.explode(F.sequence(F.floor(F.col(o) / side), F.floor((F.col(o) + (px - 1)) / side)))
    sought = placed.withColumns({"x0": x0, "y0": y0}).withColumn("x", axis("x0")).withColumn("y", axis("y0"))
    sought = sought.where("x >= 0 and y >= 0").groupBy("x", "y").agg(F.collect_list(F.struct("id", "ogx", "ogy", "x0", "y0")).alias("windows"))  # 40 bytes each
    sought = sought.withColumn("morton", morton(F.col("x"), F.col("y")))
    found = sought.join(tiles.select("morton", "pixels"), "morton", "left").select("x", "y", "windows", "pixels")
    out = placed.withColumn("p", F.lit(None).cast("struct<dx:int,dy:int,w:int,h:int,part:binary>")).schema
    shown = found.mapInArrow(_shown(side, px, bands, to_arrow_schema(out)), out)
    # Packed parts say little of their size: Spark would put any number of windows into one task.
    tasks = -(-points.count() * px * px * bands // TASK_BYTES)
    parts = shown.repartition(max(1, tasks), "id", "ogx", "ogy").groupBy("id", "ogx", "ogy").agg(F.collect_list("p").alias("parts"))  # a window's tiles are few
    return parts.mapInArrow(_pasted(px, bands, swap), f"id {dict(parts.dtypes)['id']}, ogx double, ogy double, pixels binary")

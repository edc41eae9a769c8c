"""Whole workflows as lazy plans: area inference, data set construction and field calibration."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import WINDOW_PX, ZOOM, box_centre_lonlat, box_to_px, yolo_label
from ..functions.raster import assembled, predicted
from ..operators import evaluate, greedy, splits, windows
from ..operators._rows import numbered


def located(boxes: DataFrame, zoom: int = ZOOM) -> DataFrame:
    """(id, lon, lat, score) of predicted boxes."""
    lon, lat = box_centre_lonlat(F.col("cx"), F.col("cy"), F.col("ogx"), F.col("ogy"), zoom)
    return boxes.where("error is null").select("id", lon.alias("lon"), lat.alias("lat"), "score")


def infer_area(polygons: DataFrame, tiles: DataFrame, refs: DataFrame, load: Callable, conf: float = 0.4, overlap: float = 0.2, dedup_m: float = 10.0, match_m: float = 25.0, zoom: int = ZOOM, px: int = WINDOW_PX):
    """(kept detections, matched, unmatched detections, unmatched reference points) of an area."""
    centres = windows.windows_over_polygon(polygons, zoom, px, overlap).select(F.xxhash64("polygon", "iy", "ix").alias("id"), "iy", "ix", "lon", "lat")
    cut = assembled(windows.window_tiles(centres, zoom, px), tiles, px)
    found = located(predicted(cut, load, conf, px), zoom)
    kept = greedy.dedup(numbered(found, "ord", F.col("id"), F.col("lon"), F.col("lat"), F.col("score")), dedup_m)
    inside = windows.points_in_polygon(refs, polygons)
    return kept, *greedy.match(kept, inside, match_m)


def dataset_records(sources: dict[str, DataFrame], cell_deg: float | None = 0.05, seed: int = 0, zoom: int = ZOOM, px: int = WINDOW_PX) -> DataFrame:
    """(name, lon, lat, part, label) of all sources: a window round each record, its box as a label in it (null: a negative)."""
    records = splits.named_records(sources)
    split = splits.spatial_split(records, cell_deg, seed) if cell_deg else splits.random_split(records, "name", seed)
    placed = windows.with_origin(split, zoom, px)
    box = F.when(F.col("bbox").isNotNull(), box_to_px(F.col("bbox"), F.col("ogx"), F.col("ogy"), zoom, px))
    return placed.select("source_rank", "ord", "name", "lon", "lat", "part", yolo_label(box, px).alias("label"))


def calibrate(verdicts: DataFrame, boxes: DataFrame, radius_m: float = 25.0, zoom: int = ZOOM) -> DataFrame:
    """Precision and recall by threshold from one prediction at the least confidence; boxes have the verdict's id."""
    from ..operators.distance import fired_in_own_window

    best = fired_in_own_window(verdicts, located(boxes, zoom), radius_m)
    scored = best.select(F.col("best").alias("score"), (F.col("verdict") == evaluate.TRUE).alias("is_true"))
    return evaluate.sweep(scored, evaluate.thresholds(verdicts.sparkSession))

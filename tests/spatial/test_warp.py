import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skylattice.functions import geo
from skylattice.functions.conic import ARRAYS, LAMBERT_93, from_mercator, mercator_bounds, to_mercator
from skylattice.operators import warp
from skylattice.sources import tiles

BLOCK = "ord bigint, left double, top double, res double, width int, height int, col int, row int, w int, h int, pixels binary"


def test_projection_at_known_places():
    lon, lat = np.array([3.0, 2.3522]), np.array([46.5, 48.8566])
    east, north = LAMBERT_93.forward(lon, lat, ARRAYS)
    assert np.allclose([east[0], north[0]], [700_000, 6_600_000], atol=1e-6) and np.allclose([east[1], north[1]], [652_469.02, 6_862_035.26], atol=0.02)


def test_projection_is_conformal_and_true_on_its_parallels():
    a, e2 = LAMBERT_93.axis, LAMBERT_93.e2
    lon, lat = (g.ravel() for g in np.meshgrid(np.linspace(-5, 10, 7), np.array([42.0, 44.0, 46.5, 49.0, 51.0])))
    d = 1e-5
    (x0, y0), (x1, y1), (x2, y2) = (np.array(LAMBERT_93.forward(lon + dx, lat + dy, ARRAYS)) for dx, dy in ((0, 0), (d, 0), (0, d)))
    w = 1 - e2 * np.sin(np.radians(lat + d / 2)) ** 2
    along = np.hypot(x1 - x0, y1 - y0) / (np.radians(d) * a * np.cos(np.radians(lat)) / np.sqrt(1 - e2 * np.sin(np.radians(lat)) ** 2))
    across = np.hypot(x2 - x0, y2 - y0) / (np.radians(d) * a * (1 - e2) / w**1.5)
    assert np.allclose(along, across, atol=1e-6) and np.allclose(along[(lat == 44) | (lat == 49)], 1, atol=1e-6) and (along[lat == 46.5] < 1).all() and (along[lat == 51] > 1).all()


def test_columns_and_arrays_go_there_and_back(spark):
    rng = np.random.default_rng(0)
    lon, lat = rng.uniform(-5, 10, 300), rng.uniform(41, 52, 300)
    back = LAMBERT_93.inverse(*LAMBERT_93.forward(lon, lat, ARRAYS), ARRAYS)
    assert np.abs(np.array(back) - [lon, lat]).max() < 1e-10
    df = spark.createDataFrame(list(zip(lon.tolist(), lat.tolist())), "lon double, lat double")
    east, north = LAMBERT_93.forward(F.col("lon"), F.col("lat"))
    got = np.array(df.select(east, north, *LAMBERT_93.inverse(east, north)).collect()).T
    assert np.allclose(got[:2], LAMBERT_93.forward(lon, lat, ARRAYS), atol=1e-6) and np.allclose(got[2:], [lon, lat], atol=1e-10)
    assert spark.createDataFrame([(None, 1.0)], "lon double, lat double").select(LAMBERT_93.forward(F.col("lon"), F.col("lat"))[0]).first()[0] is None


def test_bounds_hold_bent_edges(spark):
    box = spark.createDataFrame([(100_000.0, 6_900_000.0, 1_200_000.0, 7_050_000.0)], "left double, bottom double, right double, top double")
    got = box.select(mercator_bounds(F.struct("*")).alias("b")).first().b
    xs, ys = np.linspace(100_000, 1_200_000, 20_001), np.linspace(6_900_000, 7_050_000, 2001)
    edge = [np.concatenate([xs, xs, np.full(2001, xs[0]), np.full(2001, xs[-1])]), np.concatenate([np.full(20_001, ys[0]), np.full(20_001, ys[-1]), ys, ys])]
    x, y = to_mercator(*LAMBERT_93.inverse(*edge, ARRAYS), ARRAYS)
    assert np.allclose(got, [x.min(), y.min(), x.max(), y.max()], atol=400)
    corners = to_mercator(*LAMBERT_93.inverse(np.array([xs[0], xs[-1]] * 2), np.repeat(ys[[0, -1]], 2), ARRAYS), ARRAYS)[1]
    assert got.bottom < corners.min() - 3000 or got.top > corners.max() + 3000  # corners alone would miss the bend


def blocks_of(ord_, image, left, top, res, side):
    h, w = image.shape[:2]
    return [(ord_, left, top, res, w, h, c, r, min(side, w - c), min(side, h - r), bytearray(image[r : r + side, c : c + side].tobytes())) for r in range(0, h, side) for c in range(0, w, side)]


def whole(images, zoom=19, side=256):
    """Each raster warped at once over the whole scene, the last non-zero pixel staying: {(x, y): tile}."""
    out = {}
    for image, left, top, res in images:
        h, w = image.shape[:2]
        gx, gy = warp.grid_px(*warp._outline(left, top - h * res, left + w * res, top), zoom, LAMBERT_93)
        x0, x1, y0, y1 = (int(v) for v in (gx.min() - 2, gx.max() + 3, gy.min() - 2, gy.max() + 3))
        sx, sy = warp.source_px(*np.meshgrid(np.arange(x0, x1) + 0.5, np.arange(y0, y1) + 0.5), left, top, res, zoom, LAMBERT_93)
        seen = warp.sampled(image, 0, 0, w, h, sx, sy)
        for y, x in zip(*np.nonzero(seen.any(axis=-1))):
            tile = out.setdefault(((x0 + x) // side, (y0 + y) // side), np.zeros((side, side, image.shape[2]), np.uint8))
            tile[(y0 + y) % side, (x0 + x) % side] = seen[y, x]
    return out


@pytest.mark.parametrize("side", [17, 64, 500])
def test_blocks_give_what_whole_rasters_give(spark, side):
    rng = np.random.default_rng(side)
    images = [(rng.integers(0, 256, (150, 190, 3), np.uint8), 652_000.0 + 30 * i, 6_862_000.0 - 21.3 * i, 0.31) for i in range(4)]
    images[2][0][40:90, 30:100] = 0  # a hole: what lies below shows
    rows = [b for i, (image, *place) in enumerate(images) for b in blocks_of(i, image, *place, side)]
    rows += rows[:3] + [(9, None, 1.0, 0.3, 2, 2, 0, 0, 2, 2, bytearray(12)), (9, 652_000.0, 6_862_000.0, 0.3, 2, 2, 0, 0, 2, 2, bytearray(5)), (9, 652_000.0, 6_862_000.0, 0.3, 2, 2, 0, 0, 2, 2, None)]
    got = {(r.x, r.y): np.frombuffer(r.pixels, np.uint8).reshape(256, 256, 3) for r in warp.warped(spark.createDataFrame(rows, BLOCK).repartition(7)).collect()}
    want = whole(images)
    assert got.keys() == want.keys() and all((got[k] == want[k]).all() for k in want)


def test_very_many_rasters_on_one_place_keep_their_order(spark, monkeypatch):
    monkeypatch.setattr(warp, "TOGETHER", 3)
    images = [(np.full((20, 20, 1), 1 + i, np.uint8), 652_000.0, 6_862_000.0, 0.3) for i in range(25)]
    rows = [b for i, (image, *place) in enumerate(images) for b in blocks_of(i, image, *place, 8)]
    got = warp.warped(spark.createDataFrame(rows, BLOCK).repartition(5), bands=1).collect()
    assert {v for r in got for v in r.pixels} == {0, 25}
    assert warp.warped(spark.createDataFrame([], BLOCK)).count() == 0


def test_a_mark_lands_on_its_pixel(spark):
    """A bright spot at a known place shows at that place's pixel, and the outside is black."""
    image, left, top, res = np.zeros((400, 400, 3), np.uint8), 652_000.0, 6_862_000.0, 0.2
    image[:] = 10
    image[197:203, 297:303] = 250
    lon, lat = (float(v) for v in LAMBERT_93.inverse(np.float64(left + 300 * res), np.float64(top - 200 * res), ARRAYS))
    name = "marks"
    tiles.write_tiles(warp.warped(spark.createDataFrame(blocks_of(0, image, left, top, res, 128), BLOCK)), name, buckets=3)
    points = spark.createDataFrame([(1, lon, lat), (1, lon, lat), (2, lon + 1, lat), (3, None, lat)], "id bigint, lon double, lat double")
    got = {r.id: r for r in tiles.read_windows(spark.table(name), points, px=301).collect()}
    window = np.frombuffer(got[1].pixels, np.uint8).reshape(301, 301, 3)
    y, x = (v.mean() for v in np.nonzero(window[..., 0] > 200))
    assert abs(x - 150) < 2 and abs(y - 150) < 2 and window[150, 270].sum() == 0 and window[150, 200].all() and set(got) == {1, 2} and not any(got[2].pixels)
    gx = 256 * 2**19 / 2 * (1 + lon / 180)
    assert abs(got[1].ogx - (gx - 150.5)) < 1e-6
    # The tiles stay where they are: no exchange above their scan, whatever way the join goes.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = tiles.read_windows(spark.table(name), points, px=301)._jdf.queryExecution().sparkPlan().toString()
        final = tiles.read_windows(spark.table(name), points, px=301)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan
    lines = final.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and "morton" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    above, at = [], depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < at:
            above.append(line)
            at = depth(line)
    join = next(i for i, line in enumerate(above) if "SortMergeJoin" in line)
    assert not any("Exchange" in line for line in above[:join])


def test_windows_swap_bands_and_cut_across_tiles(spark):
    rng = np.random.default_rng(2)
    tile = {(x, y): rng.integers(0, 256, (256, 256, 3), np.uint8) for x in (100, 101) for y in (200, 201)}
    rows = [(x, y, bytearray(t.tobytes())) for (x, y), t in tile.items() if (x, y) != (101, 201)]
    tiles.write_tiles(spark.createDataFrame(rows, "x bigint, y bigint, pixels binary"), "grid", buckets=2)
    gx, gy = 101 * 256 + 3.25, 201 * 256 - 9.75
    lon, lat = spark.range(1).select(*geo.px_to_lonlat(F.lit(gx), F.lit(gy))).first()
    r = tiles.read_windows(spark.table("grid"), spark.createDataFrame([(5, lon, lat)], "id bigint, lon double, lat double"), px=100).first()
    scene = np.zeros((512, 512, 3), np.uint8)
    for x, y, pixels in rows:
        scene[(y - 200) * 256 : (y - 199) * 256, (x - 100) * 256 : (x - 99) * 256] = np.frombuffer(pixels, np.uint8).reshape(256, 256, 3)
    x0, y0 = round(gx - 50) - 100 * 256, round(gy - 50) - 200 * 256
    assert (np.frombuffer(r.pixels, np.uint8).reshape(100, 100, 3) == scene[y0 : y0 + 100, x0 : x0 + 100, ::-1]).all()


def test_windows_are_pasted_a_few_at_a_time():
    n = 2_000
    kind = pa.list_(pa.struct([*((k, pa.int32()) for k in ("dx", "dy", "w", "h")), ("part", pa.binary())]))
    parts = pa.array([None, [{"dx": 1, "dy": 2, "w": 1, "h": 1, "part": b"abc"}]] * (n // 2), kind)
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), *(pa.array(np.zeros(n)) for _ in range(2)), parts], ["id", "ogx", "ogy", "parts"])
    got = list(tiles._pasted(64, 3, True)(iter([batch])))
    assert max(b.nbytes for b in got) < n * 64 * 64 * 3 / 4
    rows = [r for b in got for r in b.to_pylist()]
    assert [r["id"] for r in rows] == list(range(n)) and not any(rows[-2]["pixels"])
    window = np.frombuffer(rows[-1]["pixels"], np.uint8).reshape(64, 64, 3)
    assert bytes(window[2, 1]) == b"cba" and np.count_nonzero(window) == 3


def test_morton_keys_interleave_bits(spark):
    pairs = [(0, 0), (1, 0), (0, 1), (5, 3), (2**31 - 1, 2**31 - 1), (524_287, 262_144)]
    want = [sum(((x >> i & 1) << 2 * i) | ((y >> i & 1) << 2 * i + 1) for i in range(31)) for x, y in pairs]
    df = spark.createDataFrame(pairs, "x bigint, y bigint").select(tiles.morton(F.col("x"), F.col("y")))
    assert [r[0] for r in df.collect()] == want


def test_inverse_mercator():
    lon, lat = from_mercator(*to_mercator(np.array([2.5]), np.array([47.25]), ARRAYS), ARRAYS)
    assert math.isclose(lon[0], 2.5) and math.isclose(lat[0], 47.25)


def test_drawn_rasters_are_dealt_out(spark, tmp_path):
    from skylattice import queries

    spark.range(600).selectExpr("id AS s_suppkey").coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    assert queries._scene(spark, str(tmp_path)).rdd.getNumPartitions() == 3


def test_tiles_and_windows_are_dealt_out_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warp, "TASK_BYTES", 2_000, raising=False)
    monkeypatch.setattr(tiles, "TASK_BYTES", 20 * 64 * 64 * 3, raising=False)
    rows = blocks_of(0, np.full((90, 90, 3), 7, np.uint8), 652_000.0, 6_862_000.0, 0.25, 30)
    warped = warp.warped(spark.createDataFrame(rows, BLOCK))
    assert warped.rdd.getNumPartitions() == -(-90 * 90 * 3 // 2_000)  # Spark would join all into one
    tiles.write_tiles(warped, "dealt", buckets=2)
    lon, lat = (float(v) for v in LAMBERT_93.inverse(np.float64(652_010.0), np.float64(6_861_990.0), ARRAYS))
    points = spark.createDataFrame([(i, lon + i * 1e-8, lat) for i in range(101)], "id bigint, lon double, lat double")
    windows = tiles.read_windows(spark.table("dealt"), points, px=64)
    assert windows.rdd.getNumPartitions() == 6 and {(r.id, any(r.pixels)) for r in windows.collect()} == {(i, True) for i in range(101)}


def test_a_tile_meets_its_windows_at_once(monkeypatch):
    """One row a tile comes in, however many windows show it, and parts leave a few at a time."""
    monkeypatch.setattr(tiles, "WINDOW_BYTES", 1 << 16)
    window = [{"id": i, "ogx": 0.0, "ogy": 0.0, "x0": 250 - i, "y0": 300} for i in range(300)]
    rows = pa.RecordBatch.from_pylist([{"x": 0, "y": 1, "windows": window, "pixels": bytes([9]) * 256 * 256 * 3}, {"x": 5, "y": 1, "windows": window[:1], "pixels": None}])
    part = pa.struct([*((k, pa.int32()) for k in ("dx", "dy", "w", "h")), ("part", pa.binary())])
    got = list(tiles._shown(256, 64, 3, pa.schema([("id", pa.int64()), ("ogx", pa.float64()), ("ogy", pa.float64()), ("p", part)]))(iter([rows])))
    out = [r for b in got for r in b.to_pylist()]
    assert max(b.nbytes for b in got) < 1 << 17 and [r["id"] for r in out] == [*range(300), 0] and out[-1]["p"] is None
    assert all(r["p"]["w"] == (min(64, 6 + i) if i <= 250 else 64 + 250 - i) and r["p"]["h"] == 64 and len(r["p"]["part"]) == r["p"]["w"] * 64 * 3 for i, r in enumerate(out[:300]))

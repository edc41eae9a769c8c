import math
import random

import numpy as np
from pyspark.sql import functions as F

from skylattice.functions import geo
from skylattice.operators import cover

RING = "id bigint, ring array<struct<lon:double,lat:double>>"


def inside(lon, lat, ring):
    """Strictly inside, by all edges."""
    odd = False
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1]):
        if (lon - x0) * (y1 - y0) == (lat - y0) * (x1 - x0) and min(x0, x1) <= lon <= max(x0, x1) and min(y0, y1) <= lat <= max(y0, y1):
            return False
        if (y0 > lat) != (y1 > lat) and lon < (x1 - x0) * (lat - y0) / (y1 - y0) + x0:
            odd = not odd
    return odd


def star(n, x, y, radius, rng, rough=0.5):
    return [(x + radius * (1 - rough * rng.random()) * math.cos(2 * math.pi * i / n), y + radius * (1 - rough * rng.random()) * math.sin(2 * math.pi * i / n)) for i in range(n)]


def comb(teeth, x, y):
    """Long teeth that reach through many cells, on exact borders now and then."""
    top = [p for i in range(teeth) for p in ((x + i / teeth, y), (x + (i + 0.5) / teeth, y + 1.0))]
    return [*top, (x + 1.0, y - 0.25), (x, y - 0.25)]


def spiral(n, x, y):
    out = [(x + i / n * math.cos(i / 9), y + i / n * math.sin(i / 9)) for i in range(n)]
    return out + [(x + (i / n + 0.01) * math.cos(i / 9), y + (i / n + 0.01) * math.sin(i / 9)) for i in reversed(range(n))]


def test_cells_agree_with_all_edges(spark, monkeypatch):
    monkeypatch.setattr(cover, "EDGES", 6)
    rng = random.Random(6)
    square = [(0.0, 0.0), (0.5, 0.0), (0.5, 0.5), (0.0, 0.5)]
    rings = [square, square + square[:1], star(300, 3.0, 45.0, 1.0, rng), star(40, -3.0, -20.0, 20.0, rng), comb(60, 2.0, 44.5), spiral(250, 3.2, 45.1), [(x / 4, y / 4) for x, y in star(30, 8, 8, 4, rng, 0.9)], [(1.0, 1.0), (2.0, 2.0)], [(rng.uniform(0, 2), rng.uniform(44, 46)) for _ in range(50)]]
    frame = spark.createDataFrame([*enumerate(rings), (100, None), (101, []), (102, [(1.0, None), (2.0, 2.0), (3.0, 1.0)])], RING).repartition(3)
    leaves = cover.cover(frame)
    for i in (*range(len(rings)), 100):
        ring = rings[i] if i < 100 else square
        xs, ys = zip(*ring)
        spots = [(rng.uniform(min(xs) - 0.1, max(xs) + 0.1), rng.uniform(min(ys) - 0.1, max(ys) + 0.1)) for _ in range(400)]
        spots += [*ring[:60], *((x, spots[k][1]) for k, (x, _) in enumerate(ring[:60])), *((spots[k][0], y) for k, (_, y) in enumerate(ring[:60])), *(((a[0] + b[0]) / 2, (a[1] + b[1]) / 2) for a, b in zip(ring[:60], ring[1:61]))]
        spots += [(round(x * 64) / 64, round(y * 64) / 64) for x, y in spots[:200]]
        points = spark.createDataFrame([(k, *p) for k, p in enumerate(spots)] + [(-1, None, 1.0)], "ord int, lon double, lat double").withColumn("level", F.lit(1))
        got = {r.ord for r in cover.points_inside(points, leaves.where(F.col("id") == i)).collect()}
        want = {k for k, p in enumerate(spots) if i < 100 and inside(*p, ring)}
        assert got == want, (i, [spots[k] for k in got ^ want][:5])


def test_a_point_in_several_rings_comes_once(spark):
    ring = lambda x: [(x, 0.0), (x + 1, 0.0), (x + 1, 1.0), (x, 1.0)]
    leaves = cover.cover(spark.createDataFrame([(1, ring(0.0)), (2, ring(0.2)), (3, ring(0.2))], RING))
    points = spark.createDataFrame([(1, 0.5, 0.5), (1, 0.5, 0.5), (2, 1.15, 0.5), (3, 3.0, 0.5)], "ord int, lon double, lat double")
    assert sorted(r.ord for r in cover.points_inside(points, leaves).collect()) == [1, 1, 2]
    none = cover.cover(spark.createDataFrame([], RING))
    assert cover.points_inside(points, none).count() == 0 and none.count() == 0


def test_a_hundred_thousand_vertices_and_millions_of_windows(spark):
    rng = random.Random(1)
    ring = star(100_000, 3.0, 46.0, 1.0, rng, 0.05)
    polygons = spark.createDataFrame([(1, ring)], RING)
    leaves = cover.cover(polygons).cache()
    sizes = leaves.where("edges is not null").select(F.size("edges").alias("n")).agg(F.max("n"), F.avg("n"), F.count("*")).first()
    assert sizes[0] < 200 and leaves.count() < 400_000
    spots = [(rng.uniform(1.9, 4.1), rng.uniform(44.9, 47.1)) for _ in range(300)] + ring[:20]
    got = {r.ord for r in cover.points_inside(spark.createDataFrame([(k, *p) for k, p in enumerate(spots)], "ord int, lon double, lat double"), leaves).collect()}
    assert got == {k for k, p in enumerate(spots) if inside(*p, ring)}
    zoom, px = 17, 160
    found = cover.windows_inside(polygons, leaves, zoom, px, 0.0).withColumn("task", F.spark_partition_id())
    by_task = sorted(r[0] for r in found.groupBy("task").agg(F.count("*")).select("count(1)").collect())
    n = sum(by_task)
    area = 0.5 * abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1])))
    cell = (px / (256 * 2**zoom) * 360) ** 2 * math.cos(math.radians(46))
    assert abs(n / (area / cell) - 1) < 0.02 and n > 1_000_000 and len(by_task) > 1 and by_task[-1] < 0.6 * n
    leaves.unpersist()


def test_windows_are_those_of_the_whole_grid(spark):
    rng = random.Random(9)
    rings = [star(50, 2.0, 46.0, 0.02, rng), [(0.5, 46.5), (0.52, 46.5), (0.52, 46.51)]]
    polygons = spark.createDataFrame(list(enumerate(rings)), RING)
    got = {(r.id, r.iy, r.ix): (r.lon, r.lat) for r in cover.windows_inside(polygons, cover.cover(polygons), 16, 64, 0.2).collect()}
    n, step, want = 256 * 2**16, 51, {}
    for i, ring in enumerate(rings):
        xs, ys = zip(*ring)
        px = lambda lon, lat: (n / 2 * (1 + lon / 180), n / 2 * (1 - math.log(math.tan(math.pi / 4 + math.radians(lat) / 2)) / math.pi))
        (gx0, gy0), (gx1, gy1) = px(min(xs), max(ys)), px(max(xs), min(ys))
        for iy in range(int((gy1 - gy0) // step) + 1):
            for ix in range(int((gx1 - gx0) // step) + 1):
                lon, lat = (gx0 + ix * step) / n * 360 - 180, math.degrees(2 * math.atan(math.exp(math.pi * (1 - 2 * (gy0 + iy * step) / n))) - math.pi / 2)
                if inside(lon, lat, ring):
                    want[i, iy, ix] = (lon, lat)
    assert got.keys() == want.keys() and len(want) > 100 and np.allclose([got[k] for k in want], list(want.values()), atol=1e-12)
    assert geo.ZOOM == 19

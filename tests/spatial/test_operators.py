import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylattice.functions import geo, raster
from skylattice.operators import distance, evaluate, greedy, splits, windows
from skylattice.plans import detection
from skylattice.sources import readers, sinks
from skylattice.streaming import review


def metres(a, b):
    x = np.sin(np.radians(b[1] - a[1]) / 2) ** 2 + np.cos(np.radians(a[1])) * np.cos(np.radians(b[1])) * np.sin(np.radians(b[0] - a[0]) / 2) ** 2
    return 2 * 6371000.0 * np.arcsin(np.sqrt(x))


def points(spark, rows):
    return spark.createDataFrame([(i, *map(float, r[:2]), None if r[2] is None else float(r[2])) for i, r in enumerate(rows)], "ord bigint, lon double, lat double, score double")


def test_haversine(spark):
    rows = spark.createDataFrame([(6.0, 43.0, 6.0, 44.0), (6.0, 43.0, 6.0, 43.0), (6.0, 43.0, 7.0, 43.0)], "a double, b double, c double, d double")
    d = [r[0] for r in rows.select(geo.haversine_m(*(F.col(c) for c in "abcd"))).collect()]
    assert 110e3 < d[0] < 112e3 and d[1] == 0.0 and 80e3 < d[2] < 83e3


def test_dedup_fixture_and_ties(spark):
    got = greedy.dedup(points(spark, [(6.0, 43.0, 0.7), (6.00002, 43.00001, 0.9), (6.01, 43.0, 0.5)]), 20.0)
    assert sorted(r.score for r in got.collect()) == [0.5, 0.9]
    # A chain: neighbours only; the middle one goes and doesn't take the third with it.  Equal and missing scores go by ord.
    chain = greedy.dedup(points(spark, [(6.0, 43.0, 0.5), (6.0, 43.0001, 0.5), (6.0, 43.0002, None)]), 15.0)
    assert sorted(r.ord for r in chain.collect()) == [0, 2]
    assert greedy.dedup(points(spark, []), 5.0).count() == 0


def test_match_fixtures(spark):
    dets = points(spark, [(6.0, 43.0, 0.9), (6.00003, 43.0, 0.8)])
    m, d, r = greedy.match(dets, points(spark, [(6.00001, 43.0, 0)]), 25.0)
    assert [(x.det, x.ref) for x in m.collect()] == [(0, 0)] and [x.ord for x in d.collect()] == [1] and r.count() == 0
    # The nearest is taken: the second detection falls through.  On equal distance the last reference wins.
    m, _, _ = greedy.match(dets, points(spark, [(6.00001, 43.0, 0), (6.0002, 43.0, 0)]), 25.0)
    assert sorted((x.det, x.ref) for x in m.collect()) == [(0, 0), (1, 1)]
    m, _, _ = greedy.match(points(spark, [(6.0, 43.0, 0.9)]), points(spark, [(6.0, 43.0001, 0), (6.0, 43.0001, 0)]), 25.0)
    assert [(x.det, x.ref) for x in m.collect()] == [(0, 1)]
    assert [x.count() for x in greedy.match(points(spark, []), points(spark, []), 5.0)] == [0, 0, 0]


@pytest.mark.parametrize("seed", [1, 2])
def test_greedy_equals_sequential(spark, seed):
    r = random.Random(seed)
    rows = [(6 + r.randint(0, 30) * 5e-5, 43 + r.randint(0, 30) * 5e-5, r.randint(0, 4) / 4) for _ in range(120)]
    refs = [(6 + r.randint(0, 30) * 5e-5, 43 + r.randint(0, 30) * 5e-5, 0) for _ in range(60)]
    kept = []
    order = sorted(range(len(rows)), key=lambda i: -rows[i][2])
    for i in order:
        if all(metres(rows[i], rows[k]) > 10 for k in kept):
            kept.append(i)
    assert sorted(x.ord for x in greedy.dedup(points(spark, rows), 10.0).collect()) == sorted(kept)
    used, want = set(), []
    for i in order:
        free = [(metres(rows[i], q), -j) for j, q in enumerate(refs) if j not in used and metres(rows[i], q) <= 25]
        if free:
            j = -min((round(d, 6), j) for d, j in free)[1]
            used.add(j)
            want.append(i)
    assert sorted(x.det for x in greedy.matches(points(spark, rows), points(spark, refs), 25.0).collect()) == sorted(want)


def test_near_and_reports(spark):
    p = spark.createDataFrame([(1, 0.6531, 47.3305), (2, 0.6551, 47.3305)], "id int, lon double, lat double")
    d = points(spark, [(0.6531, 47.3305, 0.4), (0.6531, 47.3305, 0.8)])
    assert [r.id for r in distance.exists_within(p, d, 25.0).collect()] == [1]
    assert sorted((r.id, r.best) for r in distance.max_score_within(p, d, 25.0).collect()) == [(1, 0.8), (2, 0.0)]
    v = spark.createDataFrame([(1, 0.10, 47.0, "faux"), (2, 0.20, 47.0, "faux"), (3, 0.30, 47.0, "vrai"), (4, 0.40, 47.0, "vrai")], "id int, lon double, lat double, verdict string")
    got = evaluate.verdict_report(points(spark, [(0.100001, 47, 1), (0.300001, 47, 1), (0.9, 47, 1)]), v, 25.0).first().asDict()
    assert got == {"fp_total": 2, "fp_still": 1, "fp_suppressed": 1, "tp_total": 2, "tp_kept": 1, "n_candidates_new": 3}


def test_sweep_and_recall(spark):
    s = spark.createDataFrame([(0.9, True), (0.6, True), (0.7, False), (0.3, False)], "score double, is_true boolean")
    t = spark.createDataFrame([(0.5,), (0.8,), (0.95,)], "conf double")
    got = {r.conf: (r.tp, r.fp, r.precision, r.recall) for r in evaluate.sweep(s, t).collect()}
    assert got == {0.5: (2, 1, pytest.approx(2 / 3), 1.0), 0.8: (1, 0, 1.0, 0.5), 0.95: (0, 0, 0.0, 0.0)}
    assert evaluate.sweep(s.limit(0), t).count() == 3 and evaluate.thresholds(spark).count() == 18
    assert evaluate.recall(s.limit(0), s.limit(0)).first().recall is None


def test_splits(spark):
    p = spark.createDataFrame([(i, 0.05 * i + 0.01, -0.05 * i + 0.01) for i in range(100)], "id int, lon double, lat double")
    a = splits.spatial_split(p, seed=3)
    n = {r.part: r["count"] for r in a.groupBy("part").count().collect()}
    assert sum(n.values()) == 100 and 60 <= n["train"] <= 80
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, splits.spatial_split(p, seed=3).collect()))
    n = {r.part: r["count"] for r in splits.random_split(p).groupBy("part").count().collect()}
    assert n == {"train": 70, "val": 15, "test": 15}
    assert splits.without_positions(p.withColumnRenamed("id", "ord"), [0, 5]).count() == 98
    b = splits.background_points(spark, 50, 1, 2, 3, 4)
    assert b.where("lon between 1 and 3 and lat between 2 and 4").count() == 50 and b.select("lon").distinct().count() == 50


def test_map_responses(spark):
    doc = {"elements": [{"type": "node", "lon": 1.0, "lat": 2.0, "tags": {"a": "b"}}, {"type": "way", "center": {"lon": 3.0, "lat": 4.0}}, {"type": "way"}, {"type": "way", "geometry": [{"lon": 1, "lat": 1}, {"lon": 2, "lat": 3}]}, {"type": "relation", "members": [{"type": "way", "role": "outer", "geometry": [{"lon": 0, "lat": 0}]}, {"type": "node"}, {"type": "way", "role": "inner", "geometry": [{"lon": 0, "lat": 1}]}]}]}
    df = spark.createDataFrame([(json.dumps(doc),)], "json string")
    assert [(r.lon, r.lat, r.tags) for r in readers.points(df).collect()] == [(1.0, 2.0, {"a": "b"}), (3.0, 4.0, {})]
    g = readers.geometries(df).collect()
    assert [r.type for r in g] == ["node", "way"] and len(g[1].geometry) == 2
    assert readers.relation_ways(df).count() == 2
    box = readers.geometries(df).select(geo.element_box(F.col("type"), F.col("lon"), F.col("lat"), F.col("geometry")).alias("b")).collect()[1].b
    assert (box.lon, box.lat) == (1.5, 2.0)
    assert readers.tagged_in_box(readers.points(df), 0, 0, 9, 9, (("a", "b"),)).count() == 1
    assert "(43.0,6.0,44.0,7.0)" in readers.area_query(6.0, 43.0, 7.0, 44.0) and '"boundary"' in readers.boundary_query("x")


def test_verdict_lines_and_geojson(spark, tmp_path):
    lines = ["index,lat,lon,score,verdict", "1,47.361519,0.524931,0.997,vrai", "2, 47.1 , 0.2,0.5,faux,extra", "3,47,0,0.1,skip", "4,47,0,0.1,non_revu", "5,x,0,1,vrai", "6,1,2"]
    got = readers.verdicts(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [(r.lon, r.lat, r.verdict) for r in got] == [(0.524931, 47.361519, "vrai"), (0.2, 47.1, "faux")]
    p = points(spark, [(6.1, 43.4, 0.9), (0.65, 47.33, None)])
    sinks.write_collection(sinks.geojson_features(p, {"source": "é"}), str(tmp_path / "a" / "p.geojson"))
    doc = json.loads((tmp_path / "a" / "p.geojson").read_text())
    assert doc["features"][0]["geometry"]["coordinates"] == [6.1, 43.4] and doc["features"][0]["properties"] == {"score": 0.9, "source": "é"}
    back = readers.layers(spark, {"x": str(tmp_path / "a" / "p.geojson"), "none": str(tmp_path / "no.geojson")}).orderBy("ord").collect()
    assert [(r.layer, r.lon, r.score) for r in back] == [("x", 6.1, 0.9), ("x", 0.65, None)]
    bad = spark.createDataFrame([('{"features":[{"geometry":null},{"properties":{}},{"geometry":{"coordinates":[0.65,47.33]}}]}',)], "value string")
    assert [(r.lon, r.lat) for r in readers.geojson_points(bad).collect()] == [(0.65, 47.33)]
    with pytest.raises(Exception, match="without coordinates"):
        readers.geojson_points(bad, strict=True).collect()
    t = [json.loads(r.feature)["properties"] for r in sinks.tasks(p, 'look "here"').orderBy("ord").collect()]
    assert t == [{"instruction": 'look "here"', "score": 0.9}, {"instruction": 'look "here"', "score": None}]
    assert sinks.mosaic_slots(p).count() == 2 and "names: [citerne]" in sinks.data_yaml("/x")


def test_polygon_and_windows(spark):
    s = [(0.0, 0.0), (0.02, 0.0), (0.02, 0.02)], [(0.0, 0.0), (0.0, 0.02), (0.02, 0.02)], [(1.0, 1.0)], [(0.5, 0.5), (0.501, 0.5), (0.501, 0.501), (0.5, 0.5)]
    ways = spark.createDataFrame([(0, i, [{"lon": x, "lat": y} for x, y in w]) for i, w in enumerate(s)], "rel_ord int, way_ord int, geometry array<struct<lon:double,lat:double>>")
    poly = windows.ways_to_polygons(ways)
    assert poly.select(geo.ring_area(F.col("ring"))).first()[0] == pytest.approx(0.0004)
    p = points(spark, [(0.01, 0.01, 0), (0.05, 0.05, 0), (0.0, 0.01, 0), (0.02, 0.02, 0)])
    assert [r.ord for r in windows.points_in_polygon(p, poly).collect()] == [0]
    w = windows.windows_over_polygon(poly, 16, 640)
    assert w.count() > 0 and w.where("lon > 0 and lon < 0.02 and lat > 0 and lat < 0.02").count() == w.count()


def test_box_round_trip(spark):
    p = windows.with_origin(points(spark, [(0.6531, 47.3305, 0.9)]))
    lon, lat = geo.box_centre_lonlat(F.lit(320.0), F.lit(320.0), F.col("ogx"), F.col("ogy"))
    r = p.select(lon.alias("lon"), lat.alias("lat"), geo.box_to_px(geo.fixed_box(F.col("lon"), F.col("lat"), 15.0), F.col("ogx"), F.col("ogy")).alias("b")).first()
    assert abs(r.lon - 0.6531) < 1e-9 and abs(r.lat - 47.3305) < 1e-9 and abs((r.b.x0 + r.b.x1) / 2 - 320) < 5
    box = lambda a, b: F.struct(F.lit(a).alias("x0"), F.lit(a).alias("y0"), F.lit(b).alias("x1"), F.lit(b).alias("y1"))
    one = spark.range(1).select(geo.yolo_label(box(160.0, 480.0)).alias("a"), geo.yolo_label(box(100.0, 100.0)).alias("b")).first()
    assert one.a == "0 0.500000 0.500000 0.500000 0.500000" and one.b is None


def test_raster_kernels():
    a = np.empty((256, 256, 3), np.uint8)
    a[:] = (60, 90, 60)
    a[100:141, 110:151] = (60, 200, 60)
    limits = raster.BlobLimits((40, 120, 80), (80, 255, 255), (200, 20_000), (0.3, 3))
    ((x, y, area),), = raster.blobs(a[None], limits)
    assert (x, y, area) == (130.0, 120.0, 1600.0)
    a[:] = (60, 90, 60)
    a[10:13, 10:13] = (60, 200, 60)
    assert raster.blobs(a[None], limits) == [[]]
    rgb, irc = np.full((4, 4, 3), (10, 20, 30), np.uint8), np.full((4, 4, 3), (1, 2, 200), np.uint8)
    assert raster.compose_rgn(rgb, irc)[0, 0].tolist() == [200, 20, 30] and rgb[0, 0, 0] == 10
    assert raster.median_hsv(rgb, 100, 100) is None and (raster.with_marker(np.full((256, 256, 3), 128, np.uint8), 50.4, 60.6)[61, 50] == (0, 0, 255)).all()
    m = np.zeros((5, 9), bool)
    m[:, ::2] = True
    assert len(np.unique(raster.labelled(m[None]))) == 6


def flood(m, eight):
    """Components by a plain search, as numbers from 1."""
    out = np.zeros(m.shape, int)
    n = 0
    for y, x in np.argwhere(m):
        if out[y, x] == 0:
            n += 1
            stack = [(y, x)]
            while stack:
                i, j = stack.pop()
                if 0 <= i < m.shape[0] and 0 <= j < m.shape[1] and m[i, j] and out[i, j] == 0:
                    out[i, j] = n
                    stack += [(i + a, j + b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a or b) and (eight or not (a and b))]
    return out


def test_labels_and_holes_equal_a_plain_search():
    rng = np.random.default_rng(2)
    stack = rng.random((6, 23, 31)) < np.array([0.3, 0.45, 0.5, 0.6, 0.8, 0.0])[:, None, None]
    got = raster.labelled(stack)
    assert len(np.unique(got[got > 0])) == sum(flood(m, True).max() for m in stack)
    for m, label, whole in zip(stack, got, raster.filled(stack)):
        want = flood(m, True)
        assert len(set(zip(label[m].tolist(), want[m].tolist()))) == want.max() == len(np.unique(label[m])) and (label[~m] == 0).all()
        outside = flood(~np.pad(m, 1), False)
        assert (whole == (outside != outside[0, 0])[1:-1, 1:-1]).all()


def test_blobs_with_holes_count_by_their_outer_outline():
    a = np.empty((2, 90, 90, 3), np.uint8)
    a[:] = (60, 90, 60)
    a[0, 10:50, 20:60] = (60, 200, 60)
    a[0, 20:30, 30:40] = (60, 90, 60)
    a[1, 10:70, 10:70] = (60, 200, 60)
    a[1, 20:60, 20:60] = (60, 90, 60)
    a[1, 35:45, 35:45] = (60, 200, 60)
    limits = raster.BlobLimits((40, 120, 80), (80, 255, 255), (50, 20_000), (0.3, 3))
    assert raster.blobs(a, limits) == [[(39.5, 29.5, 1521.0)], [(39.5, 39.5, 3481.0)]]
    t = np.full((1, 60, 60, 3), (60, 90, 60), np.uint8)
    for y in range(30):
        t[0, 10 + y, 10 : 11 + y] = (60, 200, 60)
    ((x, y, area),), = raster.blobs(t, limits)
    # A triangle's centre is that of its outline, a third of the way up, and its area half the square's.
    assert abs(area - 29 * 29 / 2) < 30 and abs(x - (10 + 29 / 3)) < 0.7 and abs(y - (10 + 2 * 29 / 3)) < 0.7


def test_mosaics_stay_inside_their_tiles():
    tiles = [(x, y, np.full((256, 256, 3), 10 * x + y + 1, np.uint8)) for x in range(4) for y in range(4)]
    got = raster.mosaic(tiles, 128.6, 0.6, 640)
    # 0.6 + 639 ends in the third tile, so the rounded origin 1 would need a column of a fourth: it stays where three suffice.
    assert (got > 0).all() and (raster.mosaic(tiles, 128.6, 128.6, 640) > 0).all()
    three = [t for t in tiles if t[0] < 3 and t[1] < 3]
    assert (raster.mosaic(three, 128.6, 128.0, 640) > 0).all()


def test_raster_operators_on_tables(spark):
    rows = [(1, 10, 20, bytes([9, 8, 7]) * 200, 5.0, 5.0), (2, 10, 20, bytes([50]) * 600, 0.0, 0.0), (3, 10, 20, b"short", 1.0, 1.0), (4, None, None, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id int, height int, width int, pixels binary, px double, py double")
    assert sorted((r.id, r.v) for r in raster.medians(df).collect()) == [(1, 9.0), (2, 50.0)]
    got = {r.id: bytes(r.pixels) for r in raster.composed(df, df.where("id < 3").withColumn("id", 3 - F.col("id"))).collect()}
    assert got == {1: bytes([50, 8, 7]) * 200, 2: bytes([7, 50, 50]) * 200}
    assert raster.marked(df.where("id < 3")).where("contains(hex(pixels), '0000FF')").count() == 2
    with pytest.raises(Exception, match="image [34] can't be read"):
        raster.marked(df).collect()
    assert raster.detect_blobs(df).count() == 0 and raster.medians(df.limit(0)).count() == 0


def test_predictors_take_batches_and_fail_by_window(spark):
    df = spark.range(40).select("id", F.lit(0.0).alias("ogx"), F.lit(0.0).alias("ogy"), F.when(F.col("id") != 7, F.unhex(F.repeat(F.format_string("%02x", F.col("id")), F.lit(4 * 4 * 3)))).alias("pixels"))

    def load():
        def predict(images):
            if any(a[0, 0, 0] == 13 for a in images):
                raise ValueError("bad window")
            return [[(1.0, 1.0, 0.9 if len(images) > 1 else 0.8), (2.0, 2.0, 0.1)] for _ in images]

        return predict

    got = raster.predicted(df.coalesce(1), load, 0.4, 4, at_once=8).collect()
    assert sorted(r.id for r in got) == list(range(40))
    by = {r.id: r for r in got}
    assert by[7].error == "unreadable window" and "bad window" in by[13].error and by[12].score == 0.8 and by[0].score == 0.9
    n = evaluate.window_counters(raster.predicted(df, load, 0.4, 4)).first()
    assert (n.windows, n.failed, n.fired) == (40, 2, 38)


def test_area_plan_with_a_stub(spark):
    ring = spark.createDataFrame([([(0.652, 47.3295), (0.6545, 47.3295), (0.6545, 47.3315), (0.652, 47.3315)],)], "ring array<struct<lon:double,lat:double>>")
    tiles = windows.window_tiles(windows.windows_over_polygon(ring).select("lon", "lat")).select("x", "y").distinct().withColumns({"height": F.lit(256), "width": F.lit(256), "pixels": F.lit(bytes([9]) * 256 * 256 * 3)})

    def load():
        return lambda images: [[(320.0, 320.0, 0.9), (10.0, 10.0, 0.1)] if (image == 9).all() else [] for image in images]

    kept, matched, alone, missing = detection.infer_area(ring, tiles, points(spark, [(0.65, 47.33, 0)]), load)
    centres = windows.windows_over_polygon(ring).count()
    assert kept.count() == centres > 0 and matched.count() == 0 and alone.count() == centres and missing.count() == 0


def test_records_and_review_stream(spark):
    a = spark.createDataFrame([(0, 0.65, 47.33), (1, 0.66, 47.34)], "ord bigint, lon double, lat double")
    pos = a.withColumn("bbox", geo.fixed_box(F.col("lon"), F.col("lat")))
    neg = a.withColumn("bbox", F.lit(None).cast(pos.schema["bbox"].dataType))
    rows = detection.dataset_records({"citerne": pos, "hardneg": neg}).collect()
    assert sorted(r.name for r in rows) == ["citerne_0000", "citerne_0001", "hardneg_0000", "hardneg_0001"]
    assert all((r.label is not None) == r.name.startswith("citerne") for r in rows)
    e = spark.createDataFrame([("k", "faux", 1), ("k", "vrai", 2), ("j", "skip", 1)], "key string, verdict string, ts int")
    assert {r.key: r.verdict for r in review.last_verdicts(e).collect()} == {"k": "vrai", "j": "skip"}


def test_sweep_of_many_thresholds(spark):
    s = spark.range(1, 40_001, 4).select((F.col("id") / 40_000).alias("score"), (F.col("id") % 3 == 0).alias("is_true"))
    t = spark.range(12_000).select((F.col("id") / 12_000).alias("conf"))
    got = {r.conf: (r.tp, r.fp) for r in evaluate.sweep(s, t).collect()}
    score, true = (np.array(x) for x in zip(*s.collect()))
    assert len(got) == 12_000 and all(got[c] == (int(((score >= c) & true).sum()), int(((score >= c) & ~true).sum())) for c in got)


def test_every_ring_counts(spark):
    square = lambda x: [(x, 0.0), (x + 1, 0.0), (x + 1, 1.0), (x, 1.0)]
    rings = spark.createDataFrame([(square(x),) for x in (0.0, 0.2, 5.0)], "ring array<struct<lon:double,lat:double>>")
    p = points(spark, [(0.5, 0.5, 0), (5.5, 0.5, 0), (3.0, 0.5, 0), (1.1, 0.5, 0)])
    assert sorted(r.ord for r in windows.points_in_polygon(p, rings).collect()) == [0, 1, 3]
    assert windows.points_in_polygon(p, rings.limit(0)).count() == 0


def test_page_fails_over_its_limit(spark, monkeypatch):
    f = spark.createDataFrame([("a", '{"k":1}'), ("b", '{"k":2}'), ("a", '{"k":3}')], "layer string, feature string")
    assert sinks.page("x/*LAYERS*/y", f) == 'x{"a":[{"k":1},{"k":3}],"b":[{"k":2}]}y'
    monkeypatch.setattr(sinks, "DOCUMENT_FEATURES", 2)
    with pytest.raises(ValueError, match="over 2 features"):
        sinks.page("/*LAYERS*/", f)


def test_names_past_ten_thousand(spark):
    rows = spark.range(10_050).select(F.col("id").alias("ord"), F.lit(1.0).alias("lon"), F.lit(2.0).alias("lat"), F.lit(None).cast("string").alias("bbox"))
    got = splits.named_records({"pool": rows})
    assert got.select("name").distinct().count() == 10_050 and got.where("ord = 10049").first().name == "pool_10049"


def test_distance_joins_hold_around_the_globe(spark):
    r = random.Random(4)
    spots = [(180.0, 10.0), (-180.0, 10.0), (179.99999, -75.0), (0.0, 89.9999), (120.0, -89.99995), (-3.0, 0.0), (7.0, 47.0), (50.0, 84.99), (12.0, 86.5)]
    rows = [(x + r.uniform(-1, 1) * 3e-4 / max(0.01, np.cos(np.radians(y))), max(-90, min(90, y + r.uniform(-3e-4, 3e-4))), r.random()) for x, y in spots for _ in range(14)]
    rows = [((x + 180) % 360 - 180, y, s) for x, y, s in rows]
    p = points(spark, rows)
    for radius in (0.0, 15.0, 40.0):
        want = {(i, j) for i, a in enumerate(rows) for j, b in enumerate(rows) if metres(a, b) <= radius}
        found = [(q.l.ord, q.r.ord) for q in distance.pairs_within(p, p, radius).collect()]
        # Equal points and pairs on the radius may differ by rounding.
        assert len(found) == len(set(found)) and all(abs(metres(rows[i], rows[j]) - radius) < 1e-3 for i, j in want ^ set(found))
    near = spark.createDataFrame([(1, 180.0, 0.0), (2, -179.99999, 0.0), (3, 0.0, 0.0)], "id int, lon double, lat double")
    assert sorted(x.id for x in distance.exists_within(near, points(spark, [(-180.0, 0.0, 1)]), 2.0).collect()) == [1, 2]


def test_crowded_spots_make_no_pairs(spark):
    crowd = spark.range(20_000).select("id", F.lit(6.0).alias("lon"), F.lit(43.0).alias("lat"), (F.col("id") % 100 / 100).alias("score"))
    assert distance.exists_within(crowd, crowd, 5.0).count() == 20_000
    assert distance.max_score_within(crowd, crowd, 5.0).where("best = 0.99").count() == 20_000
    rows = crowd.withColumnRenamed("id", "ord").union(points(spark, [(6.00001, 43.0, 0.98), (6.1, 43.0, None)]).select(F.col("ord") + 20_000, "lon", "lat", "score"))
    nowhere = spark.createDataFrame([(30_000, None, 43.0, 0.5), (30_001, None, None, None)], rows.schema)
    kept = greedy.dedup(rows.union(nowhere), 5.0)
    assert sorted(r.ord for r in kept.collect()) == [99, 20_001, 30_000, 30_001] and kept.columns == rows.columns


def test_distance_joins_are_dealt_out_by_rows(spark, monkeypatch):
    monkeypatch.setattr(distance, "ROWS", 200, raising=False)
    rows = [(6 + i % 20 * 1e-3, 43 + i // 20 * 1e-3, 0.5) for i in range(300)]
    pairs = distance.pairs_within(points(spark, rows), points(spark, rows), 100.0)
    per_task = [r["count"] for r in pairs.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert len(per_task) > 10 and max(per_task) < 150
    # Neighbours are 81 m apart from west to east and 111 m from south to north.
    assert sorted((x.l.ord, x.r.ord) for x in pairs.collect()) == sorted((i, j) for i in range(300) for j in range(300) if i // 20 == j // 20 and abs(i - j) <= 1)


def test_unmatched_rows_are_dealt_out_by_rows(spark, monkeypatch):
    monkeypatch.setattr(distance, "ROWS", 50)
    dets, refs = points(spark, [(6 + i * 1e-3, 43.0, 0.5) for i in range(300)]), points(spark, [(6 + i * 1e-3, 43.0, 0) for i in range(100, 500)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # what is taken is large
    try:
        found, *free = greedy.match(dets, refs, 25.0)
        for own, want in zip(free, (range(100), range(200, 400))):
            per_task = [r["count"] for r in own.groupBy(F.spark_partition_id().alias("task")).count().collect()]
            assert len(per_task) > 4 and max(per_task) < 60
            assert sorted(r.ord for r in own.collect()) == list(want)
        assert sorted((r.det, r.ref) for r in found.collect()) == [(i, i - 100) for i in range(100, 300)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_null_properties_stay(spark):
    p = points(spark, [(6.1, 43.4, None)])
    assert json.loads(sinks.geojson_features(p, {"note": None}).first().feature)["properties"] == {"score": None, "note": None}


def test_faces_between_crossing_ways():
    cross = [[(-1.0, 0.0), (3.0, 0.0)], [(-1.0, 2.0), (3.0, 2.0)], [(0.0, -1.0), (0.0, 3.0)], [(2.0, -1.0), (2.0, 3.0)], [(1.0, -1.0), (1.0, 3.0)]]
    area = lambda ring: abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:]))) / 2
    assert sorted(area(f) for f in windows.faces(cross)) == [2.0, 2.0]
    assert windows.faces([[(0.0, 0.0), (1.0, 0.0)], [(1.0, 0.0), (1.0, 1.0)]]) == [] and windows.faces([]) == []
    # A way that ends in the middle of another, one that lies on another, and the same way twice.
    tee = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)], [(2.0, 0.0), (2.0, 4.0)], [(1.0, 0.0), (3.0, 0.0)], [(2.0, 0.0), (2.0, 4.0)]]
    assert sorted(area(f) for f in windows.faces(tee)) == [8.0, 8.0]


def test_open_ways_fail(spark):
    ways = spark.createDataFrame([(4, 0, [(0.0, 0.0), (1.0, 1.0)])], "rel_ord int, way_ord int, geometry array<struct<lon:double,lat:double>>")
    with pytest.raises(Exception, match="no closed boundary in relation 4"):
        windows.ways_to_polygons(ways).collect()


def test_files_on_disk(spark, tmp_path):
    with pytest.raises(Exception, match="no raster file"):
        (tmp_path / "empty").mkdir()
        readers.raster_files(spark, str(tmp_path / "empty"))
    (tmp_path / "r" / "below").mkdir(parents=True)
    for name in ("b.tif", "a.jp2", "c.txt", "below/d.tif"):
        (tmp_path / "r" / name).write_bytes(b"123")
    names = lambda df: [x.path.rsplit("/", 1)[1] for x in df.collect()]
    assert names(readers.raster_files(spark, str(tmp_path / "r"))) == ["a.jp2", "b.tif"]
    assert sorted(names(readers.raster_files(spark, str(tmp_path / "r"), recursive=True))) == ["a.jp2", "b.tif", "d.tif"]
    chips = spark.createDataFrame([("train", "a", 1, 1, b"abc", "0 1"), ("val", "b", 1, 1, b"def", None)], "part string, name string, height int, width int, pixels binary, label string")
    sinks.write_chips(chips, str(tmp_path / "chips"))
    assert sorted((x.part, x.name, bytes(x.pixels), x.label) for x in spark.read.parquet(str(tmp_path / "chips")).collect()) == [("train", "a", b"abc", "0 1"), ("val", "b", b"def", "")]
    sinks.write_labels(chips, str(tmp_path / "labels"))
    assert sorted(x.value for x in spark.read.text(str(tmp_path / "labels")).collect()) == ["a\t0 1", "b\t"]
    assert sinks.test_images_folder(sinks.data_yaml("/x/y")) == "/x/y/images/test"
    with pytest.raises(ValueError, match="no test images"):
        sinks.test_images_folder("path: /x\n")


def test_cache_and_parts(spark):
    t = spark.createDataFrame([("a",), ("b",), ("a",)], "key string")
    hits, misses = readers.cached(t, t.where("key = 'a'").union(spark.createDataFrame([("z",)], "key string")))
    assert [x.key for x in hits.collect()] == ["a", "a"] and [x.key for x in misses.collect()] == ["b"]
    assert splits.part_lists(spark.createDataFrame([], "id int, part string")).count() == 0


def test_box_labels_round_once(spark, tmp_path):
    from skylattice import queries

    spark.createDataFrame([(2392,)], "c_custkey bigint").write.parquet(str(tmp_path / "customer.parquet"))
    assert queries.box_labels(spark, str(tmp_path)).first().label == "0 0.5000 0.5000 0.1004 0.1004"


def test_pixel_kernels_match_plain_ones():
    rng = np.random.default_rng(5)
    bgr = rng.integers(0, 256, (6, 20, 30, 3), dtype=np.uint8)
    bgr[0, :4] = bgr[0, :4, :, :1]
    hsv = raster.to_hsv(bgr)
    for low, high in (((40, 120, 80), (80, 255, 255)), ((0, 0, 0), (179, 255, 255)), ((0, 0, 0), (10, 90, 200))):
        assert np.array_equal(raster.coloured(bgr, low, high), np.all((hsv >= low) & (hsv <= high), axis=-1))
    m = rng.random((3, 9, 11)) < 0.7
    p = np.pad(m, [(0, 0), (1, 1), (1, 1)], constant_values=True)
    assert np.array_equal(raster.eroded(m), np.logical_and.reduce([p[:, y : y + 9, x : x + 11] for y in range(3) for x in range(3)]))
    p = np.pad(m, [(0, 0), (1, 1), (1, 1)], constant_values=False)
    assert np.array_equal(raster.dilated(m), np.logical_or.reduce([p[:, y : y + 9, x : x + 11] for y in range(3) for x in range(3)]))
    px, py = [0.0, 29.9, -3.0, 50.0, 15.0, 33.0], [0.0, 19.0, 5.0, 5.0, 10.5, 19.0]
    want = {i: m for i in range(6) if (m := raster.median_hsv(bgr[i], px[i], py[i])) is not None}
    assert dict(raster.medians_hsv(bgr, px, py)) == want and len(want) == 5


def test_drawn_images_are_dealt_out(spark, tmp_path):
    from skylattice import queries

    spark.range(12_000).selectExpr("id AS p_partkey").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    for name in ("detect_blobs", "median_colours", "tile_markers"):
        assert queries.QUERIES[name](spark, str(tmp_path)).rdd.getNumPartitions() == 3

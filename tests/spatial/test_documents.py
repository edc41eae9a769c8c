import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylattice.functions import raster
from skylattice.sources import documents, sinks

CHIP = "part string, name string, height int, width int, pixels binary, label string"


def test_a_large_collection_is_one_document_in_order(spark, tmp_path):
    n = 210_000
    rows = spark.range(n).select((F.lit(n) - F.col("id")).alias("ord"), F.format_string('{"type":"Feature","k":%d}', F.lit(n) - F.col("id")).alias("feature"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sinks.write_collection(rows, str(tmp_path / "sub" / "big.geojson"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = json.loads((tmp_path / "sub" / "big.geojson").read_text())
    assert [f["k"] for f in found["features"]] == list(range(1, n + 1)) and os.listdir(tmp_path / "sub") == ["big.geojson"]


def test_documents_are_indented_utf8(spark, tmp_path):
    rows = [(2, '{"b":"é \\"x\\"","c":[1,2.5]}'), (1, '{"a":{"n":null}}'), (3, None)]
    for name, some in (("some", rows), ("none", [])):
        sinks.write_collection(spark.createDataFrame(some, "ord int, feature string").repartition(3), f"file://{tmp_path}/{name}.json")
        want = {"type": "FeatureCollection", "features": [json.loads(f) for _, f in sorted(some, key=lambda r: r[0]) if f]}
        assert (tmp_path / f"{name}.json").read_text(encoding="utf-8") == json.dumps(want, ensure_ascii=False, indent=2)


def test_pages_hold_layers_in_order(spark, tmp_path):
    rows = [(layer, i, json.dumps({"k": i})) for layer in ('b "q"', "a") for i in range(50)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sinks.write_page("x = /*LAYERS*/;", spark.createDataFrame(rows, "layer string, ord int, feature string").repartition(7), str(tmp_path / "p.html"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    text = (tmp_path / "p.html").read_text()
    assert text.startswith("x = {") and text.endswith("};") and json.loads(text[4:-1]) == {layer: [{"k": i} for i in range(50)] for layer in ("a", 'b "q"')}
    sinks.write_page("/*LAYERS*/", spark.createDataFrame([], "layer string, ord int, feature string"), str(tmp_path / "e.html"))
    assert (tmp_path / "e.html").read_text() == "{}"
    with pytest.raises(ValueError, match="no place"):
        sinks.write_page("x", spark.createDataFrame([], "layer string, ord int, feature string"), str(tmp_path / "f.html"))


def test_failed_writes_leave_what_was_there(spark, tmp_path):
    rows = spark.range(40).select(F.col("id").alias("ord"), F.when(F.col("id") == 33, F.raise_error(F.lit("lost")).cast("string")).otherwise('{"a":1}').alias("feature"))
    sinks.write_collection(rows.where("ord < 5"), str(tmp_path / "c.json"))
    before = (tmp_path / "c.json").read_text()
    with pytest.raises(Exception, match="lost"):
        sinks.write_collection(rows, str(tmp_path / "c.json"))
    assert (tmp_path / "c.json").read_text() == before and os.listdir(tmp_path) == ["c.json"]
    files = rows.select(F.concat(F.lit("d/"), F.col("ord").cast("string")).alias("name"), F.col("feature").alias("content"))
    with pytest.raises(Exception, match="lost"):
        documents.write_files(files.repartitionByRange(4, "name"), str(tmp_path / "out"))
    assert not [f for _, _, names in os.walk(tmp_path / "out") for f in names]
    for bad in ("../x", "/tmp/x"):
        with pytest.raises(Exception, match="below the folder"):
            documents.write_files(spark.createDataFrame([(bad, b"")], "name string, content binary"), str(tmp_path / "out"))


def test_chip_files_decode_to_the_same_pixels(spark, tmp_path):
    rng = np.random.default_rng(0)
    images = {f"n{i}": rng.integers(0, 256, (rng.integers(1, 40), rng.integers(1, 40), 3), np.uint8) for i in range(30)}
    rows = [("train" if i % 3 else "val", name, *a.shape[:2], bytearray(a.tobytes()), "0 0.5 0.5 0.1 0.1" if i % 2 else None) for i, (name, a) in enumerate(images.items())]
    rows += [("val", "bad", 3, 3, bytearray(b"12"), "0 1"), ("val", "none", None, 3, None, None)]
    sinks.write_chip_files(spark.createDataFrame(rows, CHIP).repartition(4), str(tmp_path))
    found = spark.read.format("image").load(f"{tmp_path}/images/*").select("image.*").collect()
    got = {r.origin.rsplit("/", 1)[1].removesuffix(".png"): np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, 3) for r in found}
    assert got.keys() == images.keys() and all((got[k] == images[k]).all() for k in images)
    assert {p: sorted(os.listdir(tmp_path / "images" / p)) for p in ("train", "val")} == {p: sorted(f"{r[1]}.png" for r in rows if r[0] == p and r[1] in images) for p in ("train", "val")}
    texts = {r[1]: (tmp_path / "labels" / r[0] / f"{r[1]}.txt").read_text() for r in rows}
    assert texts == {r[1]: r[5] or "" for r in rows} and sorted(os.listdir(tmp_path)) == ["images", "labels"]


def test_contact_sheet_places_crops(spark):
    image = lambda v: bytearray(np.full((20, 30, 3), v, np.uint8).tobytes())
    rows = [(i, 20, 30, image(i), 5.0, 6.0, 15.0, 12.0) for i in range(60)]
    rows[3] = (3, 20, 30, None, None, None, None, None)
    rows[4] = (4, 20, 30, image(4), None, None, None, None)
    schema = "ord int, height int, width int, pixels binary, x0 double, y0 double, x1 double, y1 double"
    got = sinks.contact_sheet(spark.createDataFrame(rows, schema).repartition(5), side=16).collect()
    board = np.frombuffer(got[0].pixels, np.uint8).reshape(got[0].height, got[0].width, 3)
    assert len(got) == 1 and board.shape == (96, 128, 3)
    for i in (0, 3, 4, 5, 47):
        slot = board[i // 8 * 16 : i // 8 * 16 + 16, i % 8 * 16 : i % 8 * 16 + 16]
        plain = 50 if i == 3 else i
        assert (slot[0, 0] == plain).all() and (slot[-1, -1] == plain).all() and bool((slot[..., 2] > 100).any()) == (i not in (3, 4))
    assert sinks.contact_sheet(spark.createDataFrame([], schema)).count() == 0
    assert sinks.contact_sheet(spark.createDataFrame(rows[:9], schema), side=16).first().height == 32


def test_resizing_and_frames():
    ramp = np.repeat(np.arange(0, 240, 10, dtype=np.uint8)[None, :, None], 24, axis=0).repeat(3, axis=2)
    small, same = raster.resized(ramp, 12), raster.resized(ramp, 24)
    assert (same == ramp).all() and (small[0, :, 0] == [5 + 20 * i for i in range(12)]).all()
    box = raster.framed(np.zeros((20, 20, 3), np.uint8), 5, 6, 12, 14)
    on = {(y, x) for y, x in zip(*np.nonzero(box[..., 2]))}
    assert (6, 5) in on and (5, 4) in on and (14, 12) in on and (10, 8) not in on and (6, 2) not in on and (box[..., :2] == 0).all()
    assert raster.framed(np.zeros((5, 5, 3), np.uint8), -50, -50, 90, 90).sum() == 0


def test_virtual_rasters_list_their_sources(spark, tmp_path):
    import xml.etree.ElementTree as tree

    rows = [(f"/d/{i:03d}<&>.tif", 100.0 + 10 * (i % 7), 900.0 - 10 * (i // 7), 20, 20) for i in range(60)]
    rasters = spark.createDataFrame(rows, "path string, left double, top double, width int, height int")
    sinks.write_vrt(rasters.repartition(5), 0.5, str(tmp_path / "v" / "ortho.vrt"), srs='PROJCS["a<b"]', bands=2)
    doc = tree.parse(tmp_path / "v" / "ortho.vrt").getroot()
    assert (doc.get("rasterXSize"), doc.get("rasterYSize"), doc.find("SRS").text, doc.find("GeoTransform").text) == ("140", "180", 'PROJCS["a<b"]', "100.0, 0.5, 0, 900.0, 0, -0.5")
    bands = doc.findall("VRTRasterBand")
    assert [b.get("band") for b in bands] == ["1", "2"]
    for k, band in enumerate(bands, 1):
        found = [(s.find("SourceFilename").text, s.find("SourceBand").text, s.find("DstRect").get("xOff"), s.find("DstRect").get("yOff")) for s in band.findall("SimpleSource")]
        assert found == [(p, str(k), str(round((left - 100) / 0.5)), str(round((900 - top) / 0.5))) for p, left, top, _, _ in rows]
    for some, bands in ((rasters, 10), (rasters.limit(0), 1)):
        with pytest.raises(ValueError):
            sinks.write_vrt(some, 0.5, str(tmp_path / "x.vrt"), bands=bands)


def test_virtual_raster_bands_are_whole(spark, tmp_path):
    from skylattice import queries

    spark.createDataFrame([(12,), (3,), (100,)], "s_suppkey bigint").write.parquet(str(tmp_path / "supplier.parquet"))
    bands = {r.band: r.xml for r in queries.raster_documents(spark, str(tmp_path)).collect()}
    for band, xml in bands.items():
        assert xml.startswith(f'<VRTRasterBand dataType="Byte" band="{band}"><SimpleSource>') and xml.endswith("</SimpleSource></VRTRasterBand>")
        assert [xml.index(f">{k}<") for k in (3, 12, 100)] == sorted(xml.index(f">{k}<") for k in (3, 12, 100)) and xml.count("<SimpleSource>") == 3
    assert bands.keys() == {1, 2, 3}

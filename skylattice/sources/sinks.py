"""Writers of point files, tasks, labels and review pages.

Texts of features are columns, so that they are made on the executors; a document that other tools read whole is written
in parts that a commit joins.  Only ``page``, which returns a text, gathers its features, ``DOCUMENT_FEATURES`` at most.
"""

from __future__ import annotations

import json
import re
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import raster
from . import documents

#: Features that one document holds at most; larger results are written line by line.
DOCUMENT_FEATURES = 200_000


def feature(lon: Column, lat: Column, properties: Column) -> Column:
    """A point feature as JSON text; properties is a struct or map, null fields stay."""
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"), properties.alias("properties")), {"ignoreNullFields": "false"})


def geojson_features(points: DataFrame, extra: dict[str, object] | None = None) -> DataFrame:
    """(ord, feature): all columns but ord, lon and lat are properties; ``extra`` overrides."""
    fields = {c: F.col(c) for c in points.columns if c not in ("ord", "lon", "lat")} | {k: F.lit(v) for k, v in (extra or {}).items()}
    props = F.struct(*(v.alias(k) for k, v in fields.items())) if fields else F.create_map().cast("map<string,string>")
    return points.select("ord", feature(F.col("lon"), F.col("lat"), props).alias("feature"))


def tasks(points: DataFrame, instruction: str) -> DataFrame:
    """(ord, feature): review tasks with only an instruction and the score, null where it is missing."""
    score = F.coalesce(F.to_json(F.struct(F.col("score").alias("s"))), F.lit("{}"))
    value = F.when(F.col("score").isNull(), "null").otherwise(F.regexp_extract(score, r":(.*)\}", 1))
    text = F.concat(F.lit('{"type":"Feature","geometry":{"type":"Point","coordinates":['), F.col("lon").cast("string"), F.lit(","), F.col("lat").cast("string"), F.lit(f']}},"properties":{{"instruction":{json.dumps(instruction, ensure_ascii=False)},"score":'), value, F.lit("}}"))
    return points.select("ord", text.alias("feature"))


def write_lines(features: DataFrame, path: str) -> None:
    """One feature a line, in parallel."""
    features.select("feature").write.mode("overwrite").text(path)


def _indented(text: Column) -> Column:
    """JSON text over several lines, as it stands in an array of a document that is indented by two."""

    @F.arrow_udf("string")
    def out(column: pa.Array) -> pa.Array:
        return pa.array([None if t is None else json.dumps(json.loads(t), ensure_ascii=False, indent=2).replace("\n", "\n    ") for t in column.to_pylist()], pa.string())

    return out(text)


def write_collection(features: DataFrame, path: str) -> None:
    """One feature collection (ord, feature) in one file, in order, in UTF-8 and indented by two; without features its array is empty."""
    documents.write_document(
        features, path, [F.col("ord")], _indented(F.col("feature")), head='{\n  "type": "FeatureCollection",\n  "features": [', group_head="\n    ", between=",\n    ", group_tail="\n  ", tail="]\n}"
    )


#: Where a page's template takes its layers.
MARKER = "/*LAYERS*/"


def write_page(template: str, layers_: DataFrame, path: str) -> None:
    """A file of ``template`` with its marker replaced by the layers (layer, ord, feature) as JSON, of any number of features."""
    before, marker, after = template.partition(MARKER)
    if not marker:
        raise ValueError("the template has no place for layers")
    documents.write_document(layers_, path, [F.col("ord")], F.col("feature"), F.col("layer"), head=before + "{", group_head="{group}:[", between=",", group_tail="]", group_between=",", tail="}" + after)


def write_labels(records: DataFrame, path: str) -> None:
    """Label lines by part; records have part, name and label (null: a negative, empty text)."""
    records.select("part", F.concat_ws("\t", "name", F.coalesce("label", F.lit(""))).alias("value")).write.mode("overwrite").partitionBy("part").text(path)


def write_chips(chips: DataFrame, path: str) -> None:
    """Chips (part, name, height, width, pixels, label) as one table by part, pixels and label beside each other; a null label is a negative's empty one.

    Pixels stay raw; ``write_chip_files`` writes images.
    """
    chips.select("part", "name", "height", "width", "pixels", F.coalesce("label", F.lit("")).alias("label")).write.mode("overwrite").partitionBy("part").parquet(path)


def write_chip_files(chips: DataFrame, path: str) -> None:
    """Chips (part, name, height, width, pixels, label) as images/part/name.png and labels/part/name.txt; a null label is a negative's empty file.

    An unreadable chip has no image, but keeps its label.
    """
    png = chips.select(F.format_string("images/%s/%s.png", "part", "name").alias("name"), raster.png("height", "width", "pixels").alias("content")).where("content is not null")
    text = chips.select(F.format_string("labels/%s/%s.txt", "part", "name").alias("name"), F.coalesce("label", F.lit("")).cast("binary").alias("content"))
    documents.write_files(png.unionByName(text), path)


def test_images_folder(yaml: str) -> str:
    """The folder of test images that a training data description names; relative ones stand below its path."""
    fields = dict(re.findall(r"(?m)^(path|test):[ \t]*[\"']?(.*?)[\"']?[ \t]*$", yaml))
    if "test" not in fields:
        raise ValueError("the description names no test images")
    return (Path(fields.get("path", "")) / fields["test"]).as_posix()


# Fixed value: the class that is sought.
def data_yaml(root: str, names: tuple[str, ...] = ("citerne",)) -> str:
    """A training data description with absolute paths."""
    lines = [f"path: {Path(root).resolve().as_posix()}", *(f"{p}: images/{p}" for p in ("train", "val", "test")), f"nc: {len(names)}", f"names: [{', '.join(names)}]"]
    return "\n".join(lines) + "\n"


def mosaic_slots(records: DataFrame, most: int = 48, columns: int = 8) -> DataFrame:
    """The first ``most`` records (ord) with the row r and column c of their slot."""
    first = records.orderBy("ord").limit(most)
    numbered = first.select(F.sort_array(F.collect_list(F.struct("ord", F.struct("*").alias("row")))).alias("all")).select(F.posexplode("all").alias("i", "x"))
    return numbered.select(F.floor(F.col("i") / columns).cast("int").alias("r"), (F.col("i") % columns).alias("c"), "x.row.*")


def contact_sheet(crops: DataFrame, most: int = 48, columns: int = 8, side: int = 128) -> DataFrame:
    """(height, width, pixels): the first ``most`` crops (ord, height, width, pixels, x0, y0, x1, y1) with their boxes in red, each drawn to ``side`` pixels in its slot.

    Free slots are dark grey, an unreadable crop's slot too; without crops there is no sheet.  A null box isn't drawn.
    """
    slots = mosaic_slots(crops, most, columns)
    drawn = slots.select("r", "c", raster.thumbnail("height", "width", "pixels", "x0", "y0", "x1", "y1", side=side).alias("pixels"))
    sheet = drawn.agg(F.collect_list(F.struct("r", "c", "pixels")).alias("slots"))  # a sheet's slots
    return sheet.where(F.size("slots") > 0).select(raster.sheet(F.col("slots"), columns, side).alias("s")).select("s.*")


def page(template: str, layers_: DataFrame) -> str:
    """``template`` with its marker replaced by the layers (layer, feature) as JSON; like a collection, of DOCUMENT_FEATURES features in all at most."""
    if layers_.limit(DOCUMENT_FEATURES + 1).count() > DOCUMENT_FEATURES:
        raise ValueError(f"over {DOCUMENT_FEATURES} features: use write_lines")
    rows = layers_.groupBy("layer").agg(F.concat(F.lit("["), F.concat_ws(",", F.sort_array(F.collect_list("feature"))), F.lit("]")).alias("features")).orderBy("layer").collect()
    return template.replace("/*LAYERS*/", "{" + ",".join(f"{json.dumps(r.layer)}:{r.features}" for r in rows) + "}")


def vrt_sources(rasters: DataFrame, resolution: float, bands: int = 3) -> DataFrame:
    """(band, path, xoff, yoff, xsize, ysize) of rasters (path, left, top, width, height) in their common extent; halves round to even."""
    extent = rasters.agg(F.min("left").alias("minx"), F.max("top").alias("maxy"))
    placed = rasters.crossJoin(F.broadcast(extent))  # one row
    return placed.select(F.explode(F.sequence(F.lit(1), F.lit(bands))).alias("band"), "path", F.bround((F.col("left") - F.col("minx")) / resolution).cast("bigint").alias("xoff"), F.bround((F.col("maxy") - F.col("top")) / resolution).cast("bigint").alias("yoff"), F.col("width").alias("xsize"), F.col("height").alias("ysize"))


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def vrt_xml(rasters: DataFrame, resolution: float, bands: int = 3) -> DataFrame:
    """(band, path, xml): the element of each band's source in a virtual raster."""
    placed = vrt_sources(rasters, resolution, bands)
    rect = lambda name, x, y: F.format_string(f'<{name} xOff="%d" yOff="%d" xSize="%d" ySize="%d"/>', x, y, "xsize", "ysize")
    source = F.concat(F.lit('<SimpleSource><SourceFilename relativeToVRT="0">'), _escaped(F.col("path").cast("string")), F.format_string("</SourceFilename><SourceBand>%d</SourceBand>", "band"), rect("SrcRect", F.lit(0), F.lit(0)), rect("DstRect", F.col("xoff"), F.col("yoff")), F.lit("</SimpleSource>"))
    return placed.select("band", "path", source.alias("xml"))


def vrt_bands(rasters: DataFrame, resolution: float, bands: int = 3) -> DataFrame:
    """(band, xml): each band's element of a virtual raster, its sources in order of their paths; a band's text is one value."""
    joined = vrt_xml(rasters, resolution, bands).groupBy("band").agg(F.array_sort(F.collect_list(F.struct("path", "xml"))).alias("all"))
    return joined.select("band", F.concat(F.format_string('<VRTRasterBand dataType="Byte" band="%d">', "band"), F.concat_ws("", F.transform("all", lambda s: s["xml"])), F.lit("</VRTRasterBand>")).alias("xml"))


def write_vrt(rasters: DataFrame, resolution: float, path: str, srs: str = "", bands: int = 3) -> None:
    """A virtual raster file of rasters (path, left, top, width, height), each band's sources in order of their paths; at most 9 bands, and at least one raster."""
    if not 1 <= bands <= 9:
        raise ValueError("1 to 9 bands")
    e = rasters.agg(F.min("left").alias("w"), F.max("top").alias("n"), F.max(F.col("left") + F.col("width") * resolution).alias("e"), F.min(F.col("top") - F.col("height") * resolution).alias("s")).first()
    if e.w is None:
        raise ValueError("no rasters")
    size = f'rasterXSize="{round((e.e - e.w) / resolution)}" rasterYSize="{round((e.n - e.s) / resolution)}"'
    named = srs.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    head = f"<VRTDataset {size}>\n  <SRS>{named}</SRS>\n  <GeoTransform>{e.w}, {resolution}, 0, {e.n}, 0, {-resolution}</GeoTransform>\n"
    rows = vrt_xml(rasters, resolution, bands)
    documents.write_document(
        rows, path, [F.col("path")], F.concat(F.lit("    "), "xml"), F.col("band"), head=head, tail="\n</VRTDataset>",
        group_head='  <VRTRasterBand dataType="Byte" band={group}>\n', group_tail="\n  </VRTRasterBand>", group_between="\n",
    )

"""Readers of map responses, point files, review files and rasters."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINT = "struct<lon:double,lat:double>"
ELEMENT = f"struct<type:string,lon:double,lat:double,center:{POINT},geometry:array<{POINT}>,tags:map<string,string>>"
RELATION = f"struct<type:string,tags:map<string,string>,members:array<struct<type:string,role:string,geometry:array<{POINT}>>>>"

# The tags by which the sought objects are mapped.
TARGET_TAGS = (("water_tank:type", "flexible"), ("fire_hydrant:type", "flexible"), ("emergency", "water_tank"))


def elements(responses: DataFrame, json_col: str = "json", kind: str = ELEMENT) -> DataFrame:
    """(response, ord, e): the elements of map responses given as JSON text, in order; ``ord`` restarts with each response."""
    parsed = F.from_json(F.col(json_col), f"elements array<{kind}>")
    keep = [c for c in responses.columns if c != json_col]
    return responses.select(*keep, F.posexplode(parsed["elements"]).alias("ord", "e"))


def points(responses: DataFrame, json_col: str = "json") -> DataFrame:
    """(ord, lon, lat, tags): nodes by their place, others by their centre; those without a place go."""
    e = elements(responses, json_col)
    place = F.when(F.col("e.type") == "node", F.struct("e.lon", "e.lat")).otherwise(F.struct("e.center.lon", "e.center.lat"))
    out = e.withColumn("_p", place).select(*[c for c in e.columns if c != "e"], F.col("_p.lon").alias("lon"), F.col("_p.lat").alias("lat"), F.coalesce("e.tags", F.create_map().cast("map<string,string>")).alias("tags"))
    return out.where("lon is not null and lat is not null")


def geometries(responses: DataFrame, json_col: str = "json") -> DataFrame:
    """(ord, type, lon, lat, geometry, tags): nodes with a place, and all others as ways if they have geometry."""
    e = elements(responses, json_col)
    node = F.col("e.type") == "node"
    out = e.select(*[c for c in e.columns if c != "e"], F.when(node, "node").otherwise("way").alias("type"), "e.lon", "e.lat", F.when(~node, F.col("e.geometry")).alias("geometry"), F.coalesce("e.tags", F.create_map().cast("map<string,string>")).alias("tags"))
    return out.where(F.when(F.col("type") == "node", F.col("lon").isNotNull() & F.col("lat").isNotNull()).otherwise(F.coalesce(F.size("geometry") > 0, F.lit(False))))


def relation_ways(responses: DataFrame, json_col: str = "json", keep: tuple[str, ...] = ()) -> DataFrame:
    """(rel_ord, way_ord, geometry, and columns to keep): member ways with geometry of all relations, whatever their role."""
    e = elements(responses, json_col, RELATION).where(F.col("e.type") == "relation")
    ways = e.select(*keep, F.col("ord").alias("rel_ord"), F.posexplode("e.members").alias("way_ord", "m"))
    return ways.where((F.col("m.type") == "way") & (F.size("m.geometry") > 0)).select(*keep, "rel_ord", "way_ord", "m.geometry")


def tagged_in_box(rows: DataFrame, w: float, s: float, e: float, n: float, tags: tuple = TARGET_TAGS) -> DataFrame:
    """Rows (lon, lat, tags) in a box that have one of the tags: the filter a map server would apply."""
    any_tag = F.lit(False)
    for k, v in tags:
        any_tag = any_tag | F.coalesce(F.col("tags")[k] == v, F.lit(False))
    return rows.where(F.col("lon").between(w, e) & F.col("lat").between(s, n) & any_tag)


def boundaries(rows: DataFrame, name: str) -> DataFrame:
    """Rows whose tags have this name and a boundary of any value."""
    return rows.where((F.col("tags")["name"] == name) & F.map_contains_key("tags", F.lit("boundary")))


def area_query(w: float, s: float, e: float, n: float, selectors=tuple(f'["{k}"="{v}"]' for k, v in TARGET_TAGS), out: str = "center") -> str:
    """A map server's query text for nodes and ways; its boxes are south, west, north, east."""
    box = f"({s},{w},{n},{e})"
    lines = [f"  {kind}{selector}{box};" for selector in selectors for kind in ("node", "way")]
    return "\n".join(["[out:json][timeout:60];", "(", *lines, ");", f"out {out};"])


def boundary_query(name: str) -> str:
    return f'[out:json][timeout:120];\nrelation["name"="{name}"]["boundary"];\nout geom;'


def verdicts(lines: DataFrame, col: str = "value") -> DataFrame:
    """(lon, lat, verdict) of review lines index,lat,lon,score,verdict[,...]: only true and false verdicts with readable places.

    Numbers with underscores aren't read.
    """
    f = F.transform(F.split(F.col(col), ","), lambda x: F.trim(x))
    rows = lines.select(f.alias("f")).where(F.size("f") >= 5)
    read = rows.select(F.get("f", F.lit(2)).try_cast("double").alias("lon"), F.get("f", F.lit(1)).try_cast("double").alias("lat"), F.get("f", F.lit(4)).alias("verdict"))
    return read.where(F.col("verdict").isin("vrai", "faux") & F.col("lon").isNotNull() & F.col("lat").isNotNull())


FEATURES = "features array<struct<geometry:struct<type:string,coordinates:array<double>>,properties:map<string,string>>>"


def geojson_points(texts: DataFrame, col: str = "value", strict: bool = False) -> DataFrame:
    """(ord, lon, lat, score, properties) of feature collections given as text; features without a place go, or fail the query if strict."""
    f = texts.select(F.posexplode(F.from_json(F.col(col), FEATURES)["features"]).alias("ord", "f"))
    c = F.col("f.geometry.coordinates")
    has = F.coalesce(F.size(c) >= 2, F.lit(False))
    lon = F.when(has, F.get(c, F.lit(0))).otherwise(F.raise_error(F.lit("feature without coordinates")).cast("double")) if strict else F.get(c, F.lit(0))
    rows = f.select("ord", lon.alias("lon"), F.get(c, F.lit(1)).alias("lat"), F.col("f.properties")["score"].try_cast("double").alias("score"), F.col("f.properties").alias("properties"), has.alias("_has"))
    return (rows if strict else rows.where("_has")).drop("_has")


def layers(spark: SparkSession, named: dict[str, str]) -> DataFrame:
    """(layer, ord, lon, lat, score, properties) of point files by layer name; layers without a file are left out."""
    out = None
    for name, path in named.items():
        try:
            texts = spark.read.text(path, wholetext=True)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        rows = geojson_points(texts).select(F.lit(name).alias("layer"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else spark.createDataFrame([], "layer string, ord int, lon double, lat double, score double, properties map<string,string>")


def raster_files(spark: SparkSession, folder: str, pattern: str = "*.{jp2,tif}", recursive: bool = False) -> DataFrame:
    """(path, length) of raster files, by path; recursive reads folders below.  A folder without any is an error."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(folder).select("path", "length")
    if found.isEmpty():
        raise FileNotFoundError(f"no raster file in {folder}")
    return found.orderBy("path")


def cached(tiles: DataFrame, manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hits, misses): ``tiles`` (key) that a cache's manifest (key) holds, and those that are to be fetched."""
    have = manifest.select("key").distinct()
    return tiles.join(have, "key", "left_semi"), tiles.join(have, "key", "left_anti")


def images(spark: SparkSession, folder: str) -> DataFrame:
    """(path, height, width, pixels): decoded images, blue-green-red; unreadable files go."""
    return spark.read.format("image").option("dropInvalid", True).load(folder).select(F.col("image.origin").alias("path"), "image.height", "image.width", F.col("image.data").alias("pixels"))


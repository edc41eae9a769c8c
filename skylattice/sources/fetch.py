"""Sources behind HTTP: map servers as a data source of planned requests, and raster tiles through a cache table.

A request is a partition, so requests run on the executors and are tried again both within a task and by Spark.  Tiles
are fetched once: what the cache table holds isn't asked for, what is fetched is appended to it, and a tile that fails
leaves a row with its error and is asked for again by the next call.
"""

from __future__ import annotations

import json
import time
import urllib.parse
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from . import readers

AGENT = "skylattice"


@dataclass(frozen=True)
class Retry:
    """Tries in all, and seconds between two of them."""

    tries: int
    pause: float

    def __call__(self, call: Callable[[], object], sleep: Callable[[float], None] = time.sleep):
        """The result of ``call``; after the last try its error is raised again."""
        for left in range(self.tries - 1, -1, -1):
            try:
                return call()
            except Exception:
                if not left:
                    raise
                sleep(self.pause)
        raise ValueError("tries must be 1 or more")


# Retries of map requests and of single patches, timeouts in seconds of centres, geometries and tiles, and tiles fetched at once.
MAP_RETRY, PATCH_RETRY = Retry(5, 6.0), Retry(4, 5.0)
CENTRE_TIMEOUT, GEOMETRY_TIMEOUT, TILE_TIMEOUT = 90.0, 180.0, 30.0
AT_ONCE = 12


def post(url: str, query: str, timeout: float) -> str:
    """A map server's answer to a query; an error status is an error."""
    request = urllib.request.Request(url, urllib.parse.urlencode({"data": query}).encode(), {"User-Agent": AGENT})
    with urllib.request.urlopen(request, timeout=timeout) as answer:
        return answer.read().decode("utf-8")


def session() -> Callable[[str], bytes]:
    """The default tile session: a function from an address to its content."""

    def get(url: str) -> bytes:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": AGENT}), timeout=TILE_TIMEOUT) as answer:
            return answer.read()

    return get


class _Request(InputPartition):
    def __init__(self, number: int, query: str):
        super().__init__(number)
        self.number, self.query = number, query


class _MapReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self._url, self._queries, self._timeout = options["url"], json.loads(options["queries"]), float(options["timeout"])
        self._retry = Retry(int(options["tries"]), float(options["pause"]))

    def partitions(self) -> list[_Request]:
        return [_Request(i, q) for i, q in enumerate(self._queries)]

    def read(self, part: _Request) -> Iterator[tuple[int, str]]:
        yield part.number, self._retry(lambda: post(self._url, part.query, self._timeout))


class MapServer(DataSource):
    """``spark.read.format("map_server")``: a row (request, json) for each of the queries, given as a JSON list."""

    @classmethod
    def name(cls) -> str:
        return "map_server"

    def schema(self) -> str:
        return "request int, json string"

    def reader(self, schema: StructType) -> _MapReader:
        defaults = {"timeout": CENTRE_TIMEOUT, "tries": MAP_RETRY.tries, "pause": MAP_RETRY.pause}
        return _MapReader({k: self.options.get(k, str(defaults.get(k, ""))) for k in ("url", "queries", "timeout", "tries", "pause")})


def responses(spark: SparkSession, url: str, queries: list[str], timeout: float = CENTRE_TIMEOUT, retry: Retry = MAP_RETRY) -> DataFrame:
    """(request, json): the answers to ``queries``, each in a task of its own; a query that fails at every try fails the read."""
    spark.dataSource.register(MapServer)
    return spark.read.format("map_server").options(url=url, queries=json.dumps(queries), timeout=str(timeout), tries=str(retry.tries), pause=str(retry.pause)).load()


def target_points(spark: SparkSession, url: str, boxes: list[tuple[float, float, float, float]], retry: Retry = MAP_RETRY) -> DataFrame:
    """(request, ord, lon, lat, tags) of the sought objects in boxes (w, s, e, n), one request each."""
    return readers.points(responses(spark, url, [readers.area_query(*b) for b in boxes], CENTRE_TIMEOUT, retry))


def geometries(spark: SparkSession, url: str, selectors: tuple[str, ...], boxes: list[tuple[float, float, float, float]], retry: Retry = MAP_RETRY) -> DataFrame:
    """(request, ord, type, lon, lat, geometry, tags) of what the selectors name in boxes (w, s, e, n)."""
    return readers.geometries(responses(spark, url, [readers.area_query(*b, selectors=selectors, out="geom") for b in boxes], GEOMETRY_TIMEOUT, retry))


def relation_ways(spark: SparkSession, url: str, names: list[str], retry: Retry = MAP_RETRY) -> DataFrame:
    """(request, rel_ord, way_ord, geometry): the ways of the boundaries of these names."""
    return readers.relation_ways(responses(spark, url, [readers.boundary_query(n) for n in names], GEOMETRY_TIMEOUT, retry), keep=("request",))


_TILE = pa.schema([("key", pa.string()), ("content", pa.binary()), ("error", pa.string())])


def _cache(spark: SparkSession, table: str) -> DataFrame:
    if not spark.catalog.tableExists(table):
        spark.createDataFrame([], "key string, content binary, error string, run string").write.format("parquet").saveAsTable(table)
    return spark.table(table)


def prefetch(tiles: DataFrame, table: str, load: Callable[[], Callable[[str], bytes]] = session, retry: Retry = PATCH_RETRY, at_once: int = AT_ONCE) -> DataFrame:
    """(key, status): ``tiles`` (key, url) brought into the cache table: ``hit``, ``fetched`` or ``failed``.

    Each key is fetched once, ``at_once`` at a time, by a session that ``load`` makes in each task.  A failing tile
    doesn't fail the call.  The report reads the table, so looking at it again fetches nothing.  Null keys go.
    """
    spark = tiles.sparkSession
    sought = tiles.where("key is not null").groupBy("key").agg(F.min("url").alias("url"))
    have = _cache(spark, table).where("content is not null").select("key")
    run = uuid.uuid4().hex

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = load()
        for b in batches:
            for key, url in zip(b["key"].to_pylist(), b["url"].to_pylist()):
                try:
                    row = {"key": key, "content": retry(lambda: get(url)), "error": None}
                except Exception as e:  # noqa: BLE001 - one tile's failure is a row
                    row = {"key": key, "content": None, "error": repr(e)}
                yield pa.RecordBatch.from_pylist([row], _TILE)

    missing = sought.join(have, "key", "left_anti").repartition(at_once)
    missing.mapInArrow(fetched, "key string, content binary, error string").withColumn("run", F.lit(run)).write.mode("append").format("parquet").saveAsTable(table)
    found = spark.table(table).where("content is not null").groupBy("key").agg(F.max(F.when(F.col("run") == run, "fetched").otherwise("hit")).alias("found"))
    return sought.select("key").join(found, "key", "left").select("key", F.coalesce("found", F.lit("failed")).alias("status"))


def contents(tiles: DataFrame, table: str) -> DataFrame:
    """``tiles`` (key, ...) with their ``content`` from the cache table, null for those that aren't in it."""
    kept = tiles.sparkSession.table(table).where("content is not null").select("key", "content").dropDuplicates(["key"])
    return tiles.join(kept, "key", "left")

"""Registered queries of the spatial operators and their DuckDB SQL.

The driver's tables hold no places, so customers stand for mapped assets and orders for detections near them, by
arithmetic that both engines evaluate alike.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import conic, geo, raster
from .operators import distance, evaluate, greedy, metrics, splits, warp, windows
from .sources import fetch, readers, sinks, tiles
from .streaming import review

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

ASSET = """CAST(c_custkey AS BIGINT) AS id,
  CAST(0.05 AS DOUBLE) + CAST(1.01 AS DOUBLE) * (CAST(((c_custkey - c_custkey % 4) * 7919) % 10007 AS DOUBLE) / CAST(10007 AS DOUBLE)) + CAST(c_custkey % 4 AS DOUBLE) * CAST(0.00012 AS DOUBLE) AS lon,
  CAST(46.72 AS DOUBLE) + CAST(((c_custkey - c_custkey % 4) * 104729) % 10009 AS DOUBLE) / CAST(10009 AS DOUBLE) + CAST((c_custkey * 3) % 4 AS DOUBLE) * CAST(0.00009 AS DOUBLE) AS lat"""
DET = """CAST(o_orderkey AS BIGINT) AS id, a.id AS asset,
  a.lon + CAST((o_orderkey * 31) % 201 - 100 AS DOUBLE) * CAST(0.000003 AS DOUBLE) AS lon,
  a.lat + CAST((o_orderkey * 53) % 201 - 100 AS DOUBLE) * CAST(0.000002 AS DOUBLE) AS lat,
  CAST((o_orderkey * 613) % 997 AS DOUBLE) / CAST(997 AS DOUBLE) AS score"""
BASE = f"assets AS (SELECT {ASSET} FROM customer), dets AS (SELECT {DET} FROM orders JOIN assets a ON a.id = o_custkey), verdicts AS (SELECT id, lon, lat, CASE WHEN id % 3 = 0 THEN 'faux' ELSE 'vrai' END AS verdict FROM assets)"


def hav(a: str, b: str) -> str:
    return f"2 * 6371000.0 * asin(sqrt(least(1.0, sin(radians({b}.lat - {a}.lat) / 2) * sin(radians({b}.lat - {a}.lat) / 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * sin(radians({b}.lon - {a}.lon) / 2) * sin(radians({b}.lon - {a}.lon) / 2))))"


N = 256.0 * 2**19
GX, GY = f"({N / 2} * (1 + lon / 180))", f"({N / 2} * (1 - ln(tan(pi() / 4 + radians(lat) / 2)) / pi()))"


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame, key: str, rows: int) -> DataFrame:
    """``df`` in parts of about ``rows`` rows: what is drawn from a row is far larger than it, and files are dealt out by their own bytes."""
    return df.repartition(max(1, -(-df.count() // rows)), key)


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(table(spark, sf_dir, "part").select("p_partkey"), "p_partkey", 5_000)


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*ASSET.split(",\n"))


def dets(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    a = assets(spark, sf_dir).alias("a")
    return orders.join(a, F.col("a.id") == F.col("o_custkey")).select(*map(F.expr, DET.replace(" AS id, a.id", " AS id,\n a.id").split(",\n")))


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assets(spark, sf_dir).withColumn("verdict", F.expr("CASE WHEN id % 3 = 0 THEN 'faux' ELSE 'vrai' END"))


def r(c, digits: int = 3):
    return F.round(c, digits)


@query(f"WITH {BASE} SELECT d.id, round({hav('d', 'a')}, 3) AS metres FROM dets d JOIN assets a ON a.id = d.asset")
def haversine_to_asset(spark, sf_dir):
    a = assets(spark, sf_dir).select(F.col("id").alias("asset"), F.col("lon").alias("alon"), F.col("lat").alias("alat"))
    return dets(spark, sf_dir).join(a, "asset").select("id", r(geo.haversine_m(F.col("lon"), F.col("lat"), F.col("alon"), F.col("alat"))).alias("metres"))


@query(f"WITH {BASE} SELECT id, round({GX}, 3) AS gx, round({GY}, 3) AS gy, CAST(floor({GX} / 256) AS BIGINT) AS x, CAST(floor({GY} / 256) AS BIGINT) AS y, round({GX} - 256 * floor({GX} / 256), 3) AS px, round({GY} - 256 * floor({GY} / 256), 3) AS py FROM assets")
def tile_of_point(spark, sf_dir):
    lon, lat = F.col("lon"), F.col("lat")
    (gx, gy), (x, y), (px, py) = geo.global_px(lon, lat), geo.tile_of(lon, lat), geo.in_tile_px(lon, lat)
    return assets(spark, sf_dir).select("id", r(gx).alias("gx"), r(gy).alias("gy"), x.alias("x"), y.alias("y"), r(px).alias("px"), r(py).alias("py"))


@query(f"WITH {BASE} SELECT id, round({GX} / {N} * 360 - 180, 7) AS lon2, round(degrees(2 * atan(exp(pi() * (1 - 2 * {GY} / {N}))) - pi() / 2), 7) AS lat2 FROM assets")
def px_roundtrip(spark, sf_dir):
    lon, lat = geo.px_to_lonlat(*geo.global_px(F.col("lon"), F.col("lat")))
    return assets(spark, sf_dir).select("id", r(lon, 7).alias("lon2"), r(lat, 7).alias("lat2"))


_BOX = "SELECT id, lon, lat, lon - 6.5e0 / 111320e0 / cos(radians(lat)) AS w, lat - 6.5e0 / 111320e0 AS s, lon + 6.5e0 / 111320e0 / cos(radians(lat)) AS e, lat + 6.5e0 / 111320e0 AS n FROM assets"


@query(f"WITH {BASE} SELECT id, round(w, 8) AS w, round(s, 8) AS s, round(e, 8) AS e, round(n, 8) AS n FROM ({_BOX})")
def fixed_box(spark, sf_dir):
    b = geo.fixed_box(F.col("lon"), F.col("lat"))
    return assets(spark, sf_dir).select("id", b.alias("b")).select("id", *(r(F.col(f"b.{k}"), 8).alias(k) for k in "wsen"))


def _gx(v):
    return f"({N / 2} * (1 + {v} / 180))"


def _gy(v):
    return f"({N / 2} * (1 - ln(tan(pi() / 4 + radians({v}) / 2)) / pi()))"


@query(
    f"""WITH {BASE}, b AS ({_BOX}), p AS (SELECT id, {_gx('lon')} - 320 AS ogx, {_gy('lat')} - 320 AS ogy, {_gx('w')} AS x0, {_gy('n')} AS y0, {_gx('e')} AS x1, {_gy('s')} AS y1 FROM b),
c AS (SELECT id, greatest(0, least(640, x0 - ogx)) AS x0, greatest(0, least(640, y0 - ogy)) AS y0, greatest(0, least(640, x1 - ogx)) AS x1, greatest(0, least(640, y1 - ogy)) AS y1 FROM p)
SELECT id, round(x0, 3) AS x0, round(y0, 3) AS y0, round(x1, 3) AS x1, round(y1, 3) AS y1, CASE WHEN x1 > x0 AND y1 > y0 THEN printf('%d %.4f %.4f %.4f %.4f', 0, (x0 + x1) / 2 / 640, (y0 + y1) / 2 / 640, (x1 - x0) / 640, (y1 - y0) / 640) END AS label FROM c"""
)
def box_labels(spark, sf_dir):
    b = windows.with_origin(assets(spark, sf_dir)).select("id", geo.box_to_px(geo.fixed_box(F.col("lon"), F.col("lat")), F.col("ogx"), F.col("ogy")).alias("b"))
    # Rounded once to four decimals: the sixth may differ by the last bit of a logarithm, and rounding its text again would round twice.
    label = geo.yolo_label(F.col("b"), digits=4)
    return b.select("id", *(r(F.col(f"b.{k}")).alias(k) for k in ("x0", "y0", "x1", "y1")), label.alias("label"))


@query(
    f"WITH {BASE}, o AS (SELECT id, {GX} - 320 AS ogx, {GY} - 320 AS ogy FROM assets), x AS (SELECT *, unnest(range(CAST(floor(ogx / 256) AS BIGINT), CAST(floor((ogx + 639) / 256) AS BIGINT) + 1)) AS x FROM o) SELECT id, x, unnest(range(CAST(floor(ogy / 256) AS BIGINT), CAST(floor((ogy + 639) / 256) AS BIGINT) + 1)) AS y FROM x"
)
def window_tiles(spark, sf_dir):
    return windows.window_tiles(assets(spark, sf_dir)).select("id", "x", "y")


@query(ORACLES["window_tiles"].replace("SELECT id, x, unnest", "SELECT x, y, CAST(count(*) AS BIGINT) AS n_windows FROM (SELECT id, x, unnest").replace("AS y FROM x", "AS y FROM x) GROUP BY x, y"))
def distinct_tiles(spark, sf_dir):
    return windows.window_tiles(assets(spark, sf_dir)).groupBy("x", "y").agg(F.count("*").alias("n_windows"))


_Z17 = 256.0 * 2**17


@query(
    f"""WITH {BASE}, b AS (SELECT id, lon - 0.002 AS w, lat - 0.001 AS s, lon + 0.002 AS e, lat + 0.001 AS n FROM assets),
g AS (SELECT id, CAST(floor({_Z17 / 2} * (1 + w / 180) / 256) AS BIGINT) AS x0, CAST(floor({_Z17 / 2} * (1 + e / 180) / 256) AS BIGINT) AS x1, CAST(floor({_Z17 / 2} * (1 - ln(tan(pi() / 4 + radians(n) / 2)) / pi()) / 256) AS BIGINT) AS y0, CAST(floor({_Z17 / 2} * (1 - ln(tan(pi() / 4 + radians(s) / 2)) / pi()) / 256) AS BIGINT) AS y1 FROM b)
SELECT id, x, unnest(range(y0, y1 + 1)) AS y FROM (SELECT *, unnest(range(x0, x1 + 1)) AS x FROM g)"""
)
def tiles_in_bbox(spark, sf_dir):
    boxes = assets(spark, sf_dir).select("id", (F.col("lon") - F.lit(0.002)).alias("w"), (F.col("lat") - F.lit(0.001)).alias("s"), (F.col("lon") + F.lit(0.002)).alias("e"), (F.col("lat") + F.lit(0.001)).alias("n"))
    return windows.tiles_in_bbox(boxes, 17).select("id", "x", "y")


@query(f"WITH {BASE} SELECT id FROM assets a WHERE EXISTS (SELECT 1 FROM dets d WHERE abs(d.lat - a.lat) < 0.001 AND {hav('a', 'd')} <= 25)")
def exists_within(spark, sf_dir):
    return distance.exists_within(assets(spark, sf_dir), dets(spark, sf_dir), 25.0).select("id")


@query(f"WITH {BASE} SELECT a.id, round(coalesce(max(d.score), 0.0), 9) AS best FROM assets a LEFT JOIN dets d ON abs(d.lat - a.lat) < 0.001 AND {hav('a', 'd')} <= 25 GROUP BY a.id")
def max_score_near(spark, sf_dir):
    return distance.max_score_within(assets(spark, sf_dir), dets(spark, sf_dir), 25.0).select("id", r(F.col("best"), 9).alias("best"))


@query(
    f"""WITH {BASE}, m AS (SELECT verdict, EXISTS (SELECT 1 FROM dets d WHERE abs(d.lat - v.lat) < 0.001 AND {hav('v', 'd')} <= 25) AS near FROM verdicts v)
SELECT count(*) FILTER (verdict = 'faux') AS fp_total, count(*) FILTER (verdict = 'faux' AND near) AS fp_still, count(*) FILTER (verdict = 'faux' AND NOT near) AS fp_suppressed, count(*) FILTER (verdict = 'vrai') AS tp_total, count(*) FILTER (verdict = 'vrai' AND near) AS tp_kept, (SELECT count(*) FROM dets) AS n_candidates_new FROM m"""
)
def verdict_report(spark, sf_dir):
    return evaluate.verdict_report(dets(spark, sf_dir), verdicts(spark, sf_dir), 25.0)


_OWN = f"w AS (SELECT v.id, verdict, v.id % 7 = 0 AS skip, coalesce(bool_or({hav('v', 'd')} <= 25), false) AS fired, coalesce(max(d.score) FILTER ({hav('v', 'd')} <= 25), 0.0) AS best FROM verdicts v LEFT JOIN dets d ON d.asset = v.id GROUP BY ALL)"


def _own(spark, sf_dir):
    d = dets(spark, sf_dir).select(F.col("asset").alias("id"), "lon", "lat", "score")
    return distance.fired_in_own_window(verdicts(spark, sf_dir), d, 25.0).withColumn("skip", F.col("id") % 7 == 0)


@query(f"WITH {BASE}, {_OWN} SELECT count(*) FILTER (verdict = 'faux') AS fp_total, count(*) FILTER (verdict = 'faux' AND NOT fired) AS fp_suppressed, count(*) FILTER (verdict = 'vrai') AS tp_total, count(*) FILTER (verdict = 'vrai' AND fired) AS tp_kept FROM w WHERE NOT skip")
def window_fire_report(spark, sf_dir):
    return evaluate.field_report(_own(spark, sf_dir))


@query(
    f"""WITH {BASE}, {_OWN}, t AS (SELECT round(0.05 + i * 0.05, 4)::DOUBLE AS conf FROM range(18) x(i)),
c AS (SELECT conf, count(*) FILTER (best >= conf AND verdict = 'vrai') AS tp, count(*) FILTER (best >= conf AND verdict = 'faux') AS fp, count(*) FILTER (verdict = 'vrai') AS p FROM t, w GROUP BY conf)
SELECT conf, round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 9)::DOUBLE AS precision, round(CASE WHEN p = 0 THEN 0 ELSE tp / p END, 9)::DOUBLE AS recall, tp, fp FROM c"""
)
def pr_sweep(spark, sf_dir):
    scored = _own(spark, sf_dir).select(F.col("best").alias("score"), (F.col("verdict") == "vrai").alias("is_true"))
    out = evaluate.sweep(scored, evaluate.thresholds(spark))
    return out.select("conf", r(F.col("precision"), 9).alias("precision"), r(F.col("recall"), 9).alias("recall"), F.col("tp").cast("bigint").alias("tp"), F.col("fp").cast("bigint").alias("fp"))


def _ord(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("id", "ord")


# What is kept, of numbered things of which some exclude later ones: each that no kept one before it excludes.
_KEPT = """s(k, st) USING KEY (k) AS (SELECT k, CASE WHEN k IN (SELECT q FROM pr) THEN 0 ELSE 1 END FROM o
 UNION SELECT k, st FROM (SELECT m.k, CASE WHEN max(CASE WHEN e.st = 1 THEN 1 ELSE 0 END) = 1 THEN 2 WHEN min(e.st) = 2 THEN 1 ELSE 0 END AS st
  FROM recurring.s m JOIN pr ON pr.q = m.k JOIN recurring.s e ON e.k = pr.p WHERE m.st = 0 GROUP BY m.k) WHERE st > 0)"""


@query(
    f"""WITH RECURSIVE {BASE}, o AS MATERIALIZED (SELECT id, lon, lat, row_number() OVER (ORDER BY score DESC, id) AS k FROM dets),
pr AS MATERIALIZED (SELECT a.k AS p, b.k AS q FROM o a JOIN o b ON a.k < b.k AND abs(a.lat - b.lat) < 0.0002 AND abs(a.lon - b.lon) < 0.0004 AND {hav('a', 'b')} <= 10), {_KEPT}
SELECT id FROM s JOIN o USING (k) WHERE st = 1"""
)
def dedup_greedy(spark, sf_dir):
    return greedy.dedup(_ord(dets(spark, sf_dir)), 10.0).select(F.col("ord").alias("id"))


_MATCHED = f"""{BASE}, d AS (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS rk FROM dets),
near AS (SELECT d.id AS det, a.id AS ref, rk, {hav('d', 'a')} AS m FROM d JOIN assets a ON abs(a.lat - d.lat) < 0.001 AND abs(a.lon - d.lon) < 0.002),
o AS MATERIALIZED (SELECT det, ref, row_number() OVER (ORDER BY rk, m, ref DESC) AS k FROM near WHERE m <= 25),
pr AS MATERIALIZED (SELECT a.k AS p, b.k AS q FROM o a JOIN o b ON a.det = b.det AND a.k < b.k UNION SELECT a.k, b.k FROM o a JOIN o b ON a.ref = b.ref AND a.k < b.k), {_KEPT},
pair AS (SELECT det, ref FROM s JOIN o USING (k) WHERE st = 1)"""


@query(f"WITH RECURSIVE {_MATCHED} SELECT det, ref FROM pair")
def match_greedy(spark, sf_dir):
    return greedy.matches(_ord(dets(spark, sf_dir)), _ord(assets(spark, sf_dir)), 25.0).select("det", "ref")


@query(f"WITH RECURSIVE {_MATCHED}, n AS (SELECT count(*) AS n FROM pair) SELECT 'matched' AS status, n FROM n UNION ALL SELECT 'detected_only', (SELECT count(*) FROM dets) - n FROM n UNION ALL SELECT 'reference_only', (SELECT count(*) FROM assets) - n FROM n")
def match_status_counts(spark, sf_dir):
    parts = zip(("matched", "detected_only", "reference_only"), greedy.match(_ord(dets(spark, sf_dir)), _ord(assets(spark, sf_dir)), 25.0))
    a, b, c = (df.agg(F.count("*").alias("n")).select(F.lit(name).alias("status"), "n") for name, df in parts)
    return a.union(b).union(c)


@query(
    f"""WITH {BASE}, c AS (SELECT CAST(floor(lon / 0.05::DOUBLE) AS BIGINT) AS cx, CAST(floor(lat / 0.05::DOUBLE) AS BIGINT) AS cy, id FROM assets),
p AS (SELECT cx, cy, count(*) AS n FROM c GROUP BY cx, cy), o AS (SELECT cx, cy, coalesce(sum(n) OVER (ORDER BY md5('0:' || cx || ':' || cy), cx, cy ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(n) OVER () AS total FROM p)
SELECT id, CASE WHEN before < total * 0.7::DOUBLE THEN 'train' WHEN before < total * 0.7::DOUBLE + total * 0.15::DOUBLE THEN 'val' ELSE 'test' END AS part FROM c JOIN o USING (cx, cy)"""
)
def spatial_split(spark, sf_dir):
    return splits.spatial_split(assets(spark, sf_dir)).select("id", "part")


@query(f"WITH {BASE}, o AS (SELECT id, row_number() OVER (ORDER BY md5('0:' || id), id) - 1 AS k, count(*) OVER () AS n FROM assets) SELECT id, CASE WHEN k < floor(n * 0.7::DOUBLE) THEN 'train' WHEN k < floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS part FROM o")
def random_split(spark, sf_dir):
    return splits.random_split(assets(spark, sf_dir)).select("id", "part")


@query(f"WITH {BASE} SELECT id FROM assets ORDER BY md5('7:' || id), id LIMIT 40")
def seeded_sample(spark, sf_dir):
    """A sampling operator: forty rows are its result."""
    return splits.sample_if_more(assets(spark, sf_dir), 40, seed=7).select("id")


@query(
    f"""WITH {BASE}, u AS (SELECT 0 AS source_rank, 'positive' AS src, id AS ord FROM assets UNION ALL SELECT 1, 'pool', id FROM dets UNION ALL SELECT 2, verdict, id FROM verdicts WHERE verdict = 'faux')
SELECT source_rank, ord, src || '_' || printf('%04d', row_number() OVER (PARTITION BY src ORDER BY ord) - 1) AS name FROM u"""
)
def record_names(spark, sf_dir):
    boxed = lambda df: df.select(F.col("id").alias("ord"), "lon", "lat", geo.fixed_box(F.col("lon"), F.col("lat")).alias("bbox"))
    bad = verdicts(spark, sf_dir).where("verdict = 'faux'").select(F.col("id").alias("ord"), "lon", "lat", F.lit(None).cast("struct<w:double,s:double,e:double,n:double>").alias("bbox"))
    return splits.named_records({"positive": boxed(assets(spark, sf_dir)), "pool": boxed(dets(spark, sf_dir)), "faux": bad}).select("source_rank", "ord", "name")


_RASTERS = "ras AS (SELECT s_suppkey AS id, CAST(s_suppkey % 7 AS DOUBLE) * 1000.25 AS l, 9000.5 + CAST(s_suppkey % 11 AS DOUBLE) * 500.75 AS t FROM supplier)"


def _rasters(spark, sf_dir):
    return table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS path", "CAST(s_suppkey % 7 AS DOUBLE) * CAST(1000.25 AS DOUBLE) AS left", "CAST(9000.5 AS DOUBLE) + CAST(s_suppkey % 11 AS DOUBLE) * CAST(500.75 AS DOUBLE) AS top", "100 AS width", "200 AS height")


@query(f"WITH {_RASTERS} SELECT unnest([1, 2, 3]) AS band, id AS path, CAST(round_even((l - (SELECT min(l) FROM ras)) / 0.5, 0) AS BIGINT) AS xoff, CAST(round_even(((SELECT max(t) FROM ras) - t) / 0.5, 0) AS BIGINT) AS yoff, 100 AS xsize, 200 AS ysize FROM ras")
def raster_offsets(spark, sf_dir):
    return sinks.vrt_sources(_rasters(spark, sf_dir), 0.5)


_HALF = 3.141592653589793 * 6378137.0


@query(f"WITH {_RASTERS} SELECT id, CAST(floor((l + {_HALF}) / 0.75) AS BIGINT) AS x0, CAST(floor(({_HALF} - t) / 0.75) AS BIGINT) AS y0, CAST(ceil((l + 333.3 + {_HALF}) / 0.75) AS BIGINT) AS x1, CAST(ceil(({_HALF} - (t - 333.3)) / 0.75) AS BIGINT) AS y1 FROM ras")
def grid_snap(spark, sf_dir):
    b = F.struct("left", "top", (F.col("left") + F.lit(333.3)).alias("right"), (F.col("top") - F.lit(333.3)).alias("bottom"))
    return _rasters(spark, sf_dir).select(F.col("path").alias("id"), geo.snapped(b, 0.75).alias("s")).select("id", "s.*")


@query("SELECT l_partkey AS id, min(l_extendedprice) AS w, min(l_quantity) AS s, max(l_extendedprice) AS e, max(l_quantity) AS n FROM lineitem GROUP BY l_partkey")
def bbox_of_group(spark, sf_dir):
    points = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id"), F.col("l_extendedprice").alias("lon"), F.col("l_quantity").alias("lat"))
    return windows.bounds_of(points, "id")


def _channel(c, k, top, m):
    q = ", ".join(f"round(quantile_cont({k}, {f}), 6) AS {n}" for f, n in ((0.0, "low"), (0.1, "p10"), (0.5, "median"), (0.9, "p90"), (1.0, "high")))
    return f"SELECT '{c}' AS channel, {q}, CAST(trunc(greatest(0, quantile_cont({k}, 0.1) - {m})) AS INTEGER) AS lower, CAST(trunc(least({top}, quantile_cont({k}, 0.9) + {m})) AS INTEGER) AS upper FROM smp"


@query("WITH smp AS (SELECT CAST(l_partkey % 180 AS DOUBLE) AS h, CAST(l_orderkey % 256 AS DOUBLE) AS s, CAST((l_suppkey * 37 + l_orderkey) % 256 AS DOUBLE) AS v FROM lineitem) " + " UNION ALL ".join(_channel(c, c, t, m) for c, t, m in (("h", 179, 5), ("s", 255, 30), ("v", 255, 30))))
def hsv_percentiles(spark, sf_dir):
    s = table(spark, sf_dir, "lineitem").selectExpr("CAST(l_partkey % 180 AS DOUBLE) AS h", "CAST(l_orderkey % 256 AS DOUBLE) AS s", "CAST((l_suppkey * 37 + l_orderkey) % 256 AS DOUBLE) AS v")
    out = evaluate.hsv_bounds(s)
    return out.select("channel", *(r(F.col(c), 6).alias(c) for c in ("low", "p10", "median", "p90", "high")), "lower", "upper")


_RING = ((0.2, 46.9), (0.8, 46.85), (0.9, 47.3), (0.55, 47.1), (0.3, 47.5))
_EDGES = "ring(i, x0, y0, x1, y1) AS (VALUES " + ", ".join(f"({i}, {a[0]}e0, {a[1]}e0, {b[0]}e0, {b[1]}e0)" for i, (a, b) in enumerate(zip(_RING, (*_RING[1:], _RING[0])))) + ")"


def _ring(spark):
    return spark.range(1).select(F.array(*(F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in _RING)).alias("ring"))


_PARITY = "count(*) FILTER ((y0 > lat) <> (y1 > lat) AND lon < (x1 - x0) * (lat - y0) / nullif(y1 - y0, 0) + x0) % 2 = 1"


@query(f"WITH {BASE}, {_EDGES} SELECT id FROM assets, ring GROUP BY id HAVING {_PARITY}")
def assets_in_polygon(spark, sf_dir):
    return windows.points_in_polygon(assets(spark, sf_dir), _ring(spark)).select("id")


_N12 = 256.0 * 2**12


def _g12(lon, lat):
    return f"({_N12 / 2} * (1 + {lon} / 180))", f"({_N12 / 2} * (1 - ln(tan(pi() / 4 + radians({lat}) / 2)) / pi()))"


_GX0, _GY0 = _g12("(0.2e0 + dx)", "(47.5e0 + dy)")
_GX1, _GY1 = _g12("(0.9e0 + dx)", "(46.85e0 + dy)")


@query(
    f"""WITH {_EDGES}, n AS (SELECT n_nationkey AS id, CAST(n_nationkey AS DOUBLE) * 0.013e0 AS dx, CAST(n_nationkey AS DOUBLE) * 0.007e0 AS dy FROM nation), b AS (SELECT *, {_GX0} AS gx0, {_GY0} AS gy0, {_GX1} AS gx1, {_GY1} AS gy1 FROM n),
l AS (SELECT *, unnest(range(CAST(floor((gy1 - gy0) / 51) AS BIGINT) + 1)) AS iy FROM b), g AS (SELECT *, unnest(range(CAST(floor((gx1 - gx0) / 51) AS BIGINT) + 1)) AS ix FROM l),
c AS (SELECT id, dx, dy, iy, ix, (gx0 + ix * 51) / {_N12} * 360 - 180 AS lon, degrees(2 * atan(exp(pi() * (1 - 2 * (gy0 + iy * 51) / {_N12}))) - pi() / 2) AS lat FROM g),
e AS (SELECT id, iy, ix, lon, lat, x0 + dx AS x0, x1 + dx AS x1, y0 + dy AS y0, y1 + dy AS y1 FROM c, ring)
SELECT id, iy, ix, round(lon, 7) AS lon, round(lat, 7) AS lat FROM e GROUP BY id, iy, ix, lon, lat HAVING {_PARITY}"""
)
def grid_windows_in_polygon(spark, sf_dir):
    """Window grids over a polygon a nation."""
    k = F.col("n_nationkey").cast("double")
    ring = F.array(*(F.struct((F.lit(x) + k * F.lit(0.013)).alias("lon"), (F.lit(y) + k * F.lit(0.007)).alias("lat")) for x, y in _RING))
    w = windows.windows_over_polygon(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"), ring.alias("ring")), 12, 64, 0.2)
    return w.select(F.col("nation").alias("id"), "iy", "ix", r(F.col("lon"), 7).alias("lon"), r(F.col("lat"), 7).alias("lat"))


@query("SELECT event_type || '=' || json_extract_string(props, '$.k') AS tag, count(*) AS n, min(event_id) AS first FROM events GROUP BY 1")
def tag_histogram(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("ord"), F.create_map("event_type", F.get_json_object("props", "$.k")).alias("tags"))
    return evaluate.tag_histogram(e)


@query("SELECT event_id AS response, CASE WHEN event_id % 3 = 0 THEN 'node' ELSE 'centre' END AS place, round(CASE WHEN event_id % 3 = 0 THEN event_id / 1000.0 ELSE event_id / 2000.0 END, 6)::DOUBLE AS lon, event_type AS tag FROM events WHERE event_id % 3 <> 2")
def map_points(spark, sf_dir):
    lon = F.col("event_id") / 1000.0
    node = F.col("event_id") % 3 == 0
    e = F.struct(F.when(node, "node").otherwise("way").alias("type"), F.when(node, lon).alias("lon"), F.when(node, F.lit(47.0)).alias("lat"), F.when(F.col("event_id") % 3 == 1, F.struct((lon / 2).alias("lon"), F.lit(46.0).alias("lat"))).alias("center"), F.create_map(F.lit("t"), F.col("event_type")).alias("tags"))
    responses = table(spark, sf_dir, "events").select(F.col("event_id").alias("response"), F.to_json(F.struct(F.array(e).alias("elements"))).alias("json"))
    p = readers.points(responses)
    return p.select("response", F.when(F.col("lat") == 47.0, "node").otherwise("centre").alias("place"), r(F.col("lon"), 6).alias("lon"), F.col("tags")["t"].alias("tag"))


@query(f"WITH {BASE} SELECT round(lon, 5) AS lon, round(lat, 5) AS lat, verdict FROM verdicts")
def review_lines(spark, sf_dir):
    lines = verdicts(spark, sf_dir).select("id", F.concat_ws(",", "id", F.col("lat").cast("string"), F.concat(F.lit(" "), F.col("lon").cast("string")), F.lit("0.5"), "verdict", F.lit("more")).alias("value"))
    skipped = lines.withColumn("value", F.regexp_replace("value", "vrai|faux", "skip"))
    return readers.verdicts(lines.union(skipped)).select(r(F.col("lon"), 5).alias("lon"), r(F.col("lat"), 5).alias("lat"), "verdict")


@query(f"WITH {BASE} SELECT id AS ord, CASE WHEN score < 0.2 THEN NULL ELSE round(score, 6) END AS score, 'check' AS instruction, 2 AS n_properties FROM dets")
def review_tasks(spark, sf_dir):
    d = _ord(dets(spark, sf_dir)).select("ord", "lon", "lat", F.when(F.col("score") >= 0.2, F.col("score")).alias("score"))
    props = F.get_json_object("feature", "$.properties")
    return sinks.tasks(d, "check").select("ord", r(F.get_json_object(props, "$.score").try_cast("double"), 6).alias("score"), F.get_json_object(props, "$.instruction").alias("instruction"), F.size(F.from_json(props, "map<string,string>")).alias("n_properties"))


@query(f"WITH {BASE} SELECT id AS ord, 'Feature' AS type, round(lon, 6) AS lon, round(lat, 6) AS lat, round(score, 6) AS score, 'run' AS source FROM dets")
def geojson_features(spark, sf_dir):
    f = sinks.geojson_features(_ord(dets(spark, sf_dir)).drop("asset").withColumn("source", F.lit("old")), {"source": "run"})
    get = lambda p: F.get_json_object("feature", p)
    num = lambda p: r(get(p).cast("double"), 6)
    return f.select("ord", get("$.type").alias("type"), num("$.geometry.coordinates[0]").alias("lon"), num("$.geometry.coordinates[1]").alias("lat"), num("$.properties.score").alias("score"), get("$.properties.source").alias("source"))


_STATE = "CASE id % 6 WHEN 0 THEN 'vrai' WHEN 1 THEN 'faux' WHEN 2 THEN 'skip' END"
_REVIEW = f"WITH {BASE}, st AS (SELECT id, {_STATE} AS verdict FROM dets)"


def _state(spark, sf_dir):
    """A review of all detections: some true, some false, some skipped, the rest not seen."""
    return dets(spark, sf_dir).select(evaluate.review_key(F.col("lat"), F.col("lon")).alias("key"), F.expr(_STATE).alias("verdict")).groupBy("key").agg(F.max("verdict").alias("verdict"))


@query(f"{_REVIEW}, k AS (SELECT printf('%.6f,%.6f', lat, lon) AS key, max(verdict) AS verdict FROM dets JOIN st USING (id) GROUP BY 1) SELECT d.id + 1 AS index, printf('%.6f', lat) AS lat, printf('%.6f', lon) AS lon, printf('%.3f', score) AS score, coalesce(k.verdict, 'non_revu') AS verdict FROM dets d LEFT JOIN k ON k.key = printf('%.6f,%.6f', lat, lon)")
def review_export(spark, sf_dir):
    return evaluate.review_export(_ord(dets(spark, sf_dir)), _state(spark, sf_dir))


@query(f"{_REVIEW}, k AS (SELECT printf('%.6f,%.6f', lat, lon) AS key, max(verdict) AS verdict FROM dets JOIN st USING (id) GROUP BY 1), j AS (SELECT d.id AS ord, k.verdict FROM dets d LEFT JOIN k ON k.key = printf('%.6f,%.6f', lat, lon)) SELECT count(*) FILTER (verdict = 'vrai') AS vrai, count(*) FILTER (verdict = 'faux') AS faux, count(*) FILTER (verdict = 'skip') AS skip, count(*) FILTER (verdict IS NULL) AS reste, coalesce(min(ord) FILTER (verdict IS NULL), 0) AS first_open FROM j")
def review_counters(spark, sf_dir):
    return evaluate.review_counters(_ord(dets(spark, sf_dir)), _state(spark, sf_dir))


@query("SELECT l_orderkey, l_linenumber, [[(l_suppkey * 3) % 256, l_orderkey % 256, l_linenumber % 256], [l_linenumber % 256, l_suppkey % 256, 7]] AS pixels FROM lineitem")
def compose_rgn(spark, sf_dir):
    px = lambda *e: F.array(*(F.array(*(F.expr(x).cast("bigint") for x in p)) for p in e))
    rgb = px(("l_partkey % 256", "l_orderkey % 256", "l_linenumber % 256"), ("9", "l_suppkey % 256", "7"))
    irc = px(("1", "2", "(l_suppkey * 3) % 256"), ("3", "4", "l_linenumber % 256"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", raster.compose_arrays(rgb, irc).alias("pixels"))


def _block(x0: str, wide: str, high: str, on: str, off: str = "3C5A3C", y0: int = 12, side: int = 64) -> str:
    """SQL of a side x side image: a block of colour ``on`` on ``off``."""
    plain, inner = f"repeat('{off}', {side})", f"concat(repeat('{off}', {x0}), repeat('{on}', {wide}), repeat('{off}', {side} - {x0} - {wide}))"
    return f"unhex(concat(repeat({plain}, {y0}), repeat({inner}, {high}), repeat({plain}, {side} - {y0} - {high})))"


@query("SELECT p_partkey AS id, CAST(20 + p_partkey % 20 AS DOUBLE) AS px, CAST(12 + (8 + p_partkey % 9) / 2 AS DOUBLE) AS py, CAST(20 * (8 + p_partkey % 9) AS DOUBLE) AS area, 1.0::DOUBLE AS score FROM part")
def detect_blobs(spark, sf_dir):
    """Blobs on a drawn image a part: a green block on grey-green, its place and size from the key."""
    k = "CAST(p_partkey AS INT)"
    pixels = F.expr(_block(f"(10 + {k} % 20)", "21", f"(9 + {k} % 9)", "3CC83C"))
    images = _parts(spark, sf_dir).select(F.col("p_partkey").alias("id"), F.lit(64).alias("height"), F.lit(64).alias("width"), pixels.alias("pixels"))
    found = raster.detect_blobs(images, raster.BlobLimits((40, 120, 80), (80, 255, 255), (100, 20_000), (0.3, 3)))
    return found.select("id", *(r(F.col(c), 6).alias(c) for c in ("px", "py", "area", "score")))


@query("SELECT p_partkey AS id, lower(printf('%02x%02x%02x%02x%02x%02x', p_partkey * 5 % 256, p_partkey * 3 % 256, 7, p_partkey * 7 % 256, p_partkey % 11, 5)) AS pixels FROM part WHERE p_partkey % 3 <> 0")
def nir_pairs(spark, sf_dir):
    """Windows in colour and in near infrared, joined and composed; a third has no infrared."""
    part = table(spark, sf_dir, "part").selectExpr("p_partkey AS id", "p_partkey AS k", "1 AS height", "2 AS width")
    drawn = lambda df, *v: df.withColumn("pixels", F.unhex(F.format_string("%02x" * 6, *(F.expr(e) for e in v))))
    rgb = drawn(part, "k % 256", "k * 3 % 256", "7", "9", "k % 11", "5")
    irc = drawn(part.where("k % 3 <> 0"), "1", "2", "k * 5 % 256", "3", "4", "k * 7 % 256")
    return raster.composed(rgb, irc).select("id", F.lower(F.hex("pixels")).alias("pixels"))


_GREY = "SELECT p_partkey AS id, CAST(p_partkey % 24 AS BIGINT) AS x, CAST(p_partkey * 7 % 24 AS BIGINT) AS y, CAST(p_partkey % 256 AS DOUBLE) AS a, CAST(p_partkey * 5 % 256 AS DOUBLE) AS b FROM part"


def _grey(spark, sf_dir):
    """Images of 24 x 24 pixels, the left half in one grey and the right half in another."""
    pixels = "unhex(repeat(concat(repeat(format_string('%02x', k % 256), 36), repeat(format_string('%02x', k * 5 % 256), 36)), 24))"
    return _parts(spark, sf_dir).selectExpr("p_partkey AS id", "p_partkey AS k").selectExpr("id", "24 AS height", "24 AS width", f"{pixels} AS pixels", "CAST(k % 24 AS DOUBLE) AS px", "CAST(k * 7 % 24 AS DOUBLE) AS py")


@query(f"WITH g AS ({_GREY}), n AS (SELECT *, greatest(0, least(12, x + 5) - greatest(0, x - 4)) AS l, least(24, x + 5) - greatest(0, x - 4) AS w FROM g) SELECT id, 0.0::DOUBLE AS h, 0.0::DOUBLE AS s, CASE WHEN 2 * l > w THEN a WHEN 2 * l < w THEN b ELSE (a + b) / 2 END AS v FROM n")
def median_colours(spark, sf_dir):
    return raster.medians(_grey(spark, sf_dir))


@query(f"WITH g AS ({_GREY}) SELECT id, CAST(least(24, x + 11) - greatest(0, x - 10) + least(24, y + 11) - greatest(0, y - 10) - 1 AS BIGINT) AS red FROM g")
def tile_markers(spark, sf_dir):
    shown = raster.marked(_grey(spark, sf_dir))
    return shown.select("id", raster.coloured_pixels(F.col("pixels"), (0, 0, 255)).alias("red"))


@query(f"WITH {BASE} SELECT id, round(lon, 7) AS lon2, round(lat, 7) AS lat2 FROM assets")
def tile_px_roundtrip(spark, sf_dir):
    p = (F.col("lon"), F.col("lat"))
    lon, lat = geo.tile_px_to_lonlat(*geo.tile_of(*p), *geo.in_tile_px(*p))
    return assets(spark, sf_dir).select("id", r(lon, 7).alias("lon2"), r(lat, 7).alias("lat2"))


@query("SELECT event_id, round(2 * pi() * 6378137.0 / (256 * pow(2, event_id % 20)) * 640, 6) AS metres FROM events")
def ground_resolution(spark, sf_dir):
    """Metres that a window spans, at a zoom an event."""
    metres = F.element_at(F.array(*(F.lit(geo.metres_per_px(z)) for z in range(20))), (F.col("event_id") % 20 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", r(metres * 640, 6).alias("metres"))


_TILE = f"CAST(floor({GX} / 256) AS BIGINT) AS x, CAST(floor({GY} / 256) AS BIGINT) AS y"


@query(f"WITH {BASE}, t AS (SELECT id, {_TILE} FROM assets) SELECT id, 'https://tiles/A.B/19/' || x || '/' || y AS url, CASE WHEN id % 2 = 0 THEN '19_' || x || '_' || y || '.jpg' ELSE '19_' || x || '_' || y || '_irc.jpg' END AS key FROM t")
def tile_urls(spark, sf_dir):
    x, y = geo.tile_of(F.col("lon"), F.col("lat"))
    layer = F.when(F.col("id") % 2 == 0, "A.B").otherwise("A.B.IRC")
    return assets(spark, sf_dir).select("id", geo.tile_url(x, y, "https://tiles/{layer}/{z}/{x}/{y}", "A.B").alias("url"), geo.tile_key(x, y, layer, "A.B").alias("key"))


@query(f"WITH {BASE}, t AS (SELECT DISTINCT {_TILE} FROM assets) SELECT '19_' || x || '_' || y || '.jpg' AS key, CASE WHEN (x + y) % 3 = 0 THEN 'hit' ELSE 'miss' END AS status FROM t")
def tile_cache(spark, sf_dir):
    x, y = geo.tile_of(F.col("lon"), F.col("lat"))
    tiles = assets(spark, sf_dir).select(x.alias("x"), y.alias("y"), geo.tile_key(x, y, F.lit("A"), "A").alias("key")).distinct()
    hits, misses = readers.cached(tiles, tiles.where("(x + y) % 3 = 0"))
    return hits.select("key", F.lit("hit").alias("status")).union(misses.select("key", F.lit("miss").alias("status")))


@query(
    f"""WITH {BASE}, e AS (SELECT *, 6.5e0 / 111320e0 AS d FROM assets)
SELECT id, round(CASE WHEN id % 2 = 0 THEN lon + 0.0005 ELSE lon END, 7) AS lon2, round(CASE WHEN id % 2 = 0 THEN lat + 0.001 ELSE lat END, 7) AS lat2,
 round(CASE WHEN id % 2 = 0 THEN lon - 0.001 ELSE lon - d / cos(radians(lat)) END, 7) AS w, round(CASE WHEN id % 2 = 0 THEN lat ELSE lat - d END, 7) AS s,
 round(CASE WHEN id % 2 = 0 THEN lon + 0.002 ELSE lon + d / cos(radians(lat)) END, 7) AS e, round(CASE WHEN id % 2 = 0 THEN lat + 0.002 ELSE lat + d END, 7) AS n FROM e"""
)
def element_boxes(spark, sf_dir):
    at = lambda dx, dy: F.struct((F.col("lon") + F.lit(dx)).alias("lon"), (F.col("lat") + F.lit(dy)).alias("lat"))
    kind = F.when(F.col("id") % 2 == 0, "way").otherwise("node")
    box = geo.element_box(kind, F.col("lon"), F.col("lat"), F.array(at(0.0, 0.0), at(0.002, 0.001), at(-0.001, 0.002)))
    found = assets(spark, sf_dir).select("id", box.alias("b"))
    return found.select("id", r(F.col("b.lon"), 7).alias("lon2"), r(F.col("b.lat"), 7).alias("lat2"), *(r(F.col(f"b.bbox.{k}"), 7).alias(k) for k in "wsen"))


@query(f"WITH {BASE}, b AS (SELECT id, {GX} - 320 + id % 640 AS gx, {GY} - 320 + id * 3 % 640 AS gy FROM assets) SELECT id, round(gx / {N} * 360 - 180, 7) AS lon2, round(degrees(2 * atan(exp(pi() * (1 - 2 * gy / {N}))) - pi() / 2), 7) AS lat2 FROM b")
def box_centres(spark, sf_dir):
    lon, lat = geo.box_centre_lonlat((F.col("id") % 640).cast("double"), (F.col("id") * 3 % 640).cast("double"), F.col("ogx"), F.col("ogy"))
    return windows.with_origin(assets(spark, sf_dir)).select("id", r(lon, 7).alias("lon2"), r(lat, 7).alias("lat2"))


@query("SELECT event_id AS response, CASE event_id % 4 WHEN 0 THEN 'node' ELSE 'way' END AS type, CASE event_id % 4 WHEN 0 THEN 0 ELSE 1 + event_id % 3 END AS n_points, event_type AS tag FROM events WHERE event_id % 4 < 2")
def element_geometries(spark, sf_dir):
    """Nodes, ways with geometry, ways without, and nodes without a place; the last two go."""
    k = F.col("event_id") % 4
    points = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("event_id") % 3), lambda i: F.struct(i.cast("double").alias("lon"), F.lit(1.0).alias("lat")))
    e = F.struct(F.when(k % 3 == 0, "node").otherwise("way").alias("type"), F.when(k == 0, 1.5).alias("lon"), F.when(k == 0, 2.5).alias("lat"), F.when(k == 1, points).alias("geometry"), F.create_map(F.lit("t"), F.col("event_type")).alias("tags"))
    responses = table(spark, sf_dir, "events").select(F.col("event_id").alias("response"), F.to_json(F.struct(F.array(e).alias("elements"))).alias("json"))
    return readers.geometries(responses).select("response", "type", F.coalesce(F.size("geometry"), F.lit(0)).cast("bigint").alias("n_points"), F.col("tags")["t"].alias("tag")).withColumn("n_points", F.greatest("n_points", F.lit(0)))


@query("SELECT event_id AS response, unnest([0, 2]) AS way_ord, 2 + event_id % 2 AS n_points FROM events WHERE event_id % 3 > 0")
def member_ways(spark, sf_dir):
    """Ways of relations, whatever their role: two a relation, with a node and an empty way between."""
    line = lambda n: F.transform(F.sequence(F.lit(1).cast("bigint"), n), lambda i: F.struct(i.cast("double").alias("lon"), F.lit(1.0).alias("lat")))
    member = lambda kind, role, g: F.struct(F.lit(kind).alias("type"), F.lit(role).alias("role"), g.alias("geometry"))
    own = line(2 + F.col("event_id") % 2)
    none = F.array().cast("array<struct<lon:double,lat:double>>")
    members = F.array(member("way", "outer", own), member("node", "", none), member("way", "inner", own), member("way", "outer", none))
    e = F.struct(F.when(F.col("event_id") % 3 > 0, "relation").otherwise("way").alias("type"), members.alias("members"))
    responses = table(spark, sf_dir, "events").select(F.col("event_id").alias("response"), F.to_json(F.struct(F.array(e).alias("elements"))).alias("json"))
    ways = readers.relation_ways(responses.withColumn("rel", F.col("response")), keep=["response"])
    return ways.select("response", "way_ord", F.size("geometry").cast("bigint").alias("n_points"))


@query("SELECT c_custkey AS id FROM customer WHERE c_custkey % 5 = 1 AND c_custkey % 3 > 0")
def named_boundaries(spark, sf_dir):
    name = F.when(F.col("c_custkey") % 5 == 1, "Town").otherwise("Other")
    kind = F.when(F.col("c_custkey") % 3 > 0, F.create_map(F.lit("boundary"), F.concat(F.lit("kind"), F.col("c_custkey") % 3))).otherwise(F.create_map(F.lit("place"), F.lit("town")))
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.map_concat(F.create_map(F.lit("name"), name), kind).alias("tags"))
    return readers.boundaries(rows, "Town").select("id")


@query(f"WITH {BASE} SELECT id, round(lon, 6) AS lon, round(lat, 6) AS lat, CASE WHEN id % 3 > 0 THEN round(score, 6) END AS score FROM dets WHERE id % 5 > 1")
def point_files(spark, sf_dir):
    """Feature collections of one point each, read back; features without geometry or with one number go."""
    score = F.when(F.col("id") % 3 > 0, F.col("score"))
    place = F.when(F.col("id") % 5 > 1, F.array("lon", "lat")).when(F.col("id") % 5 == 1, F.array("lon"))
    feature = F.struct(F.when(place.isNotNull(), F.struct(F.lit("Point").alias("type"), place.alias("coordinates"))).alias("geometry"), F.struct("id", score.alias("score")).alias("properties"))
    texts = dets(spark, sf_dir).select(F.to_json(F.struct(F.array(feature).alias("features"))).alias("value"))
    return readers.geojson_points(texts).select(F.col("properties")["id"].cast("bigint").alias("id"), r(F.col("lon"), 6).alias("lon"), r(F.col("lat"), 6).alias("lat"), r(F.col("score"), 6).alias("score"))


@query("SELECT id FROM (SELECT c_custkey AS id, row_number() OVER (ORDER BY c_custkey) - 1 AS k FROM customer) WHERE k NOT IN (0, 3, 7, 100)")
def positions_excluded(spark, sf_dir):
    return splits.without_positions(_ord(assets(spark, sf_dir)), [0, 3, 7, 100]).select(F.col("ord").alias("id"))


@query(f"WITH {BASE}, m AS (SELECT id FROM assets a WHERE EXISTS (SELECT 1 FROM dets d WHERE abs(d.lat - a.lat) < 0.001 AND {hav('a', 'd')} <= 25)) SELECT (SELECT count(*) FROM m) AS matched, (SELECT count(*) FROM assets) AS total, round((SELECT count(*) FROM m) / (SELECT count(*) FROM assets), 9) AS recall")
def recall_summary(spark, sf_dir):
    a = assets(spark, sf_dir)
    return evaluate.recall(distance.exists_within(a, dets(spark, sf_dir), 25.0), a).withColumn("recall", r(F.col("recall"), 9))


def _unit(c):
    return f"CAST(('0x' || substr(md5('3:{c}:' || id), 1, 8)) AS BIGINT) / 4294967296e0"


@query(f"SELECT id AS ord, round(0.2e0 + {_unit('lon')} * 0.7e0, 9) AS lon, round(46.8e0 + {_unit('lat')} * 0.5e0, 9) AS lat FROM range((SELECT count(*) FROM supplier)) t(id)")
def background_points(spark, sf_dir):
    """As many background points as suppliers."""
    return splits.background_points(spark, table(spark, sf_dir, "supplier").count(), 0.2, 46.8, 0.9, 47.3, seed=3).select("ord", r(F.col("lon"), 9).alias("lon"), r(F.col("lat"), 9).alias("lat"))


@query("WITH b AS (SELECT o_custkey AS id, o_orderkey % 11 = 0 AS e, o_orderkey % 11 <> 0 AND o_orderkey % 4 > 0 AS f FROM orders), p AS (SELECT id, bool_or(e) AS e, bool_or(f) AS f FROM b GROUP BY id) SELECT count(*) AS windows, count(*) FILTER (e) AS failed, count(*) FILTER (f) AS fired FROM p")
def window_counters(spark, sf_dir):
    boxes = table(spark, sf_dir, "orders").selectExpr("o_custkey AS id", "CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 4 > 0 THEN 0.5D END AS score", "CASE WHEN o_orderkey % 11 = 0 THEN 'lost' END AS error")
    return evaluate.window_counters(boxes)


@query(f"{_REVIEW}, k AS (SELECT printf('%.6f,%.6f', lat, lon) AS key, max(verdict) AS verdict FROM dets JOIN st USING (id) GROUP BY 1) SELECT d.id AS ord, k.verdict, round(score, 6) AS score FROM dets d JOIN k ON k.key = printf('%.6f,%.6f', lat, lon) WHERE k.verdict = 'vrai'")
def true_positive_export(spark, sf_dir):
    f = sinks.geojson_features(evaluate.true_positives(_ord(dets(spark, sf_dir)).drop("asset"), _state(spark, sf_dir)))
    return f.select("ord", F.get_json_object("feature", "$.properties.verdict").alias("verdict"), r(F.get_json_object("feature", "$.properties.score").cast("double"), 6).alias("score"))


@query("SELECT (SELECT count(*) FROM orders) + (SELECT count(*) FROM supplier) AS n_review")
def review_size(spark, sf_dir):
    rows = {"candidates": "orders", "reference": "customer", "doubtful": "supplier"}
    parts = [table(spark, sf_dir, t).select(F.lit(name).alias("layer")) for name, t in rows.items()]
    return evaluate.review_size(parts[0].union(parts[1]).union(parts[2]), ["candidates", "doubtful"])


_RANDOM = "o AS (SELECT c_custkey AS id, row_number() OVER (ORDER BY md5('0:' || c_custkey), c_custkey) - 1 AS k, count(*) OVER () AS n FROM customer), s AS (SELECT id, CASE WHEN k < floor(n * 0.7::DOUBLE) THEN 'train' WHEN k < floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS part FROM o)"


@query(f"WITH {_RANDOM} SELECT part, row_number() OVER (PARTITION BY part ORDER BY id) - 1 AS place, id FROM s")
def part_lists(spark, sf_dir):
    return splits.part_lists(splits.random_split(assets(spark, sf_dir).select("id")))


@query(f"WITH {_RANDOM} SELECT part FROM (VALUES ('train'), ('val'), ('test'), ('extra')) v(part) WHERE part NOT IN (SELECT part FROM s)")
def empty_parts(spark, sf_dir):
    return splits.empty_parts(splits.random_split(assets(spark, sf_dir).select("id")), ("train", "val", "test", "extra"))


@query("SELECT c_custkey AS id FROM customer ORDER BY c_custkey LIMIT 60")
def first_rows(spark, sf_dir):
    """A limit in input order: sixty rows are its result."""
    return splits.first_rows(_ord(assets(spark, sf_dir)), 60).select(F.col("ord").alias("id"))


@query("SELECT CAST(floor(k / 8) AS INTEGER) AS r, CAST(k % 8 AS INTEGER) AS c, id AS ord FROM (SELECT c_custkey AS id, row_number() OVER (ORDER BY c_custkey) - 1 AS k FROM customer) WHERE k < 48")
def mosaic_slots(spark, sf_dir):
    """A contact sheet of 48 slots."""
    return sinks.mosaic_slots(_ord(assets(spark, sf_dir)).select("ord")).select("r", "c", "ord")


@query("SELECT event_type AS key, last.v AS verdict, last.t AS at FROM (SELECT event_type, max({'t': event_id % 1000, 'v': CASE event_id % 3 WHEN 0 THEN 'faux' WHEN 1 THEN 'skip' ELSE 'vrai' END}) AS last FROM events GROUP BY 1)")
def last_verdicts(spark, sf_dir):
    e = table(spark, sf_dir, "events").selectExpr("event_type AS key", "CASE event_id % 3 WHEN 0 THEN 'faux' WHEN 1 THEN 'skip' ELSE 'vrai' END AS verdict", "event_id % 1000 AS ts")
    return review.last_verdicts(e)


@query("SELECT n_nationkey AS rel_ord, round((1 + n_nationkey / 100e0) * (2 + n_nationkey / 100e0), 9) AS area FROM nation")
def largest_faces(spark, sf_dir):
    """The largest face between ways that cross mid-line: three upright and two level ones, with loose ends."""
    k = F.col("n_nationkey") / 100
    at = lambda x, y: F.struct(F.lit(x).cast("double").alias("lon") if not hasattr(x, "cast") else x.cast("double").alias("lon"), F.lit(y).cast("double").alias("lat") if not hasattr(y, "cast") else y.cast("double").alias("lat"))
    line = lambda a, b: F.array(at(*a), at(*b))
    ways = F.array(line((-0.5, -1), (-0.5, 5)), line((0, -1), (0, 5)), line((1 + k, -1), (1 + k, 5)), line((-1, 0), (5, 0)), line((-1, 2 + k), (5, 2 + k)))
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("rel_ord"), F.posexplode(ways).alias("way_ord", "geometry"))
    return windows.ways_to_polygons(rows).select("rel_ord", r(geo.ring_area(F.col("ring")), 9).alias("area"))


_VRT = """WITH ras AS (SELECT s_suppkey AS id, CAST(s_suppkey % 7 AS DOUBLE) * 1000.25 AS l, 9000.5 + CAST(s_suppkey % 11 AS DOUBLE) * 500.75 AS t FROM supplier),
o AS (SELECT b AS band, id, CAST(round_even((l - (SELECT min(l) FROM ras)) / 0.5, 0) AS BIGINT) AS x, CAST(round_even(((SELECT max(t) FROM ras) - t) / 0.5, 0) AS BIGINT) AS y FROM ras, (VALUES (1), (2), (3)) v(b))
SELECT band, printf('<VRTRasterBand dataType="Byte" band="%d">', band) || string_agg('<SimpleSource><SourceFilename relativeToVRT="0">' || id || '</SourceFilename>' || printf('<SourceBand>%d</SourceBand><SrcRect xOff="0" yOff="0" xSize="100" ySize="200"/><DstRect xOff="%d" yOff="%d" xSize="100" ySize="200"/></SimpleSource>', band, x, y), '' ORDER BY id) || '</VRTRasterBand>' AS xml FROM o GROUP BY band"""


@query(_VRT)
def raster_documents(spark, sf_dir):
    """A virtual raster's bands, whole."""
    return sinks.vrt_bands(_rasters(spark, sf_dir), 0.5)


@query(f"WITH {BASE} SELECT id FROM dets WHERE lon BETWEEN 0.3e0 AND 0.8e0 AND lat BETWEEN 46.9e0 AND 47.4e0 AND id % 4 < 2")
def tagged_places(spark, sf_dir):
    tags = F.when(F.col("id") % 4 == 0, F.create_map(F.lit("emergency"), F.lit("water_tank"))).when(F.col("id") % 4 == 1, F.create_map(F.lit("water_tank:type"), F.lit("flexible"))).when(F.col("id") % 4 == 2, F.create_map(F.lit("emergency"), F.lit("phone")))
    return readers.tagged_in_box(dets(spark, sf_dir).withColumn("tags", tags), 0.3, 46.9, 0.8, 47.4).select("id")


_SCENE = "ras AS (SELECT CAST(s_suppkey AS BIGINT) AS id, 652000e0 + CAST(s_suppkey % 10 AS DOUBLE) * 10.3e0 AS l, 6862000e0 - CAST(floor(s_suppkey / 10) AS DOUBLE) * 8.1e0 AS t FROM supplier)"
_SIZE = (48, 36, 0.25)  # columns, rows and metres a pixel of the drawn rasters
_CONE, _RADIUS, _ORIGIN = conic.LAMBERT_93._cone
_ECC = math.sqrt(conic.LAMBERT_93.e2)
_R = geo.MERCATOR_RADIUS_M
_MPP = geo.metres_per_px()


def _degrees_sql(e: str, n: str) -> str:
    """SQL of longitude and latitude (lon, lat) of an easting and northing, the latitude by iteration rather than by series."""
    x, y = f"({e} - 700000e0)", f"({_ORIGIN + 6_600_000.0!r}::DOUBLE - {n})"
    t = f"pow(sqrt({x} * {x} + {y} * {y}) / {_RADIUS!r}::DOUBLE, 1 / {_CONE!r}::DOUBLE)"
    phi = f"(pi() / 2 - 2 * atan({t}))"
    for _ in range(6):
        phi = f"list_transform([{phi}], lambda p: pi() / 2 - 2 * atan({t} * pow((1 - {_ECC!r}::DOUBLE * sin(p)) / (1 + {_ECC!r}::DOUBLE * sin(p)), {_ECC / 2!r}::DOUBLE)))[1]"
    return f"degrees(atan2({x}, {y}) / {_CONE!r}::DOUBLE) + 3 AS lon, degrees({phi}) AS lat"


_MERCATOR = f"radians(lon) * {_R!r}::DOUBLE AS mx, ln(tan(pi() / 4 + radians(lat) / 2)) * {_R!r}::DOUBLE AS my"
_EDGES_OF = f"""edge AS (SELECT id, l + {_SIZE[0] * _SIZE[2]}e0 * a / 22 AS e, t - {_SIZE[1] * _SIZE[2]}e0 * b / 22 AS n FROM ras, (SELECT i AS a, 0 AS b FROM range(23) x(i) UNION SELECT i, 22 FROM range(23) x(i) UNION SELECT 0, i FROM range(23) x(i) UNION SELECT 22, i FROM range(23) x(i))),
deg AS (SELECT id, {_degrees_sql('e', 'n')} FROM edge), mer AS (SELECT id, {_MERCATOR} FROM deg),
bnd AS (SELECT id, min(mx) AS l3, min(my) AS b3, max(mx) AS r3, max(my) AS t3 FROM mer GROUP BY id)"""


def _scene(spark, sf_dir):
    """A raster a supplier, side by side with overlaps, as blocks of 20 x 20 pixels whose numbers follow from their place."""
    w, h, res = _SIZE
    ras = dealt(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey", 250).selectExpr("CAST(s_suppkey AS BIGINT) AS ord", "652000D + CAST(s_suppkey % 10 AS DOUBLE) * 10.3D AS left", "6862000D - CAST(floor(s_suppkey / 10) AS DOUBLE) * 8.1D AS top")
    ras = ras.withColumns({"res": F.lit(res), "width": F.lit(w), "height": F.lit(h)})
    blocks = ras.withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(w - 1), F.lit(20)))).withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(h - 1), F.lit(20))))
    blocks = blocks.withColumns({"w": F.least(F.lit(20), w - F.col("col")), "h": F.least(F.lit(20), h - F.col("row"))})
    value = "transform(sequence(0, w * h * 3 - 1), i -> lpad(hex((ord * 13 + (row + i div (w * 3)) * 3 + (col + (i div 3) % w) * 5 + (i % 3) * 40) % 251), 2, '0'))"
    return blocks.withColumn("pixels", F.expr(f"unhex(array_join({value}, ''))"))


@query(f"WITH {_SCENE}, {_EDGES_OF} SELECT id, round(l3, 3) AS w, round(b3, 3) AS s, round(r3, 3) AS e, round(t3, 3) AS n FROM bnd")
def projected_bounds(spark, sf_dir):
    """Mercator bounds of rasters in the conic projection, with points put on their edges."""
    w, h, res = _SIZE
    ras = _scene(spark, sf_dir).where("col = 0 and row = 0")
    box = F.struct("left", (F.col("top") - h * res).alias("bottom"), (F.col("left") + w * res).alias("right"), "top")
    return ras.select(F.col("ord").alias("id"), conic.mercator_bounds(box).alias("b")).select("id", *(r(F.col(f"b.{k}")).alias(a) for a, k in zip("wsen", ("left", "bottom", "right", "top"))))


def _number(r_: str, c: str, k: int) -> str:
    return f"CAST((id * 13 + {r_} * 3 + {c} * 5 + {k * 40}) % 251 AS DOUBLE)"


def _between(k: int) -> str:
    return f"floor(({_number('r0', 'c0', k)} * (1 - fu) + {_number('r0', 'c1', k)} * fu) * (1 - fv) + ({_number('r1', 'c0', k)} * (1 - fu) + {_number('r1', 'c1', k)} * fu) * fv + 0.5e0)"


_T = f"(ln(tan(pi() / 4 - radians(lat) / 2)) - {_ECC / 2!r}::DOUBLE * ln((1 - {_ECC!r}::DOUBLE * sin(radians(lat))) / (1 + {_ECC!r}::DOUBLE * sin(radians(lat)))))"
_WARPED = f"""{_SCENE}, {_EDGES_OF},
box AS (SELECT id, CAST(floor((l3 + {_HALF}) / {_MPP!r}::DOUBLE) AS BIGINT) AS x0, CAST(ceil((r3 + {_HALF}) / {_MPP!r}::DOUBLE) AS BIGINT) AS x1, CAST(floor(({_HALF} - t3) / {_MPP!r}::DOUBLE) AS BIGINT) AS y0, CAST(ceil(({_HALF} - b3) / {_MPP!r}::DOUBLE) AS BIGINT) AS y1 FROM bnd),
spot AS (SELECT id, gx, unnest(range(y0, y1)) AS gy FROM (SELECT *, unnest(range(x0, x1)) AS gx FROM box)),
ll AS (SELECT *, degrees(((gx + 0.5e0) * {_MPP!r}::DOUBLE - {_HALF}) / {_R!r}::DOUBLE) AS lon, degrees(2 * atan(exp(({_HALF} - (gy + 0.5e0) * {_MPP!r}::DOUBLE) / {_R!r}::DOUBLE))) - 90 AS lat FROM spot),
en AS (SELECT id, gx, gy, {_RADIUS!r}::DOUBLE * exp({_CONE!r}::DOUBLE * {_T}) AS ra, {_CONE!r}::DOUBLE * radians(lon - 3) AS th FROM ll),
src AS (SELECT en.id, gx, gy, (ra * sin(th) + 700000e0 - l) / {_SIZE[2]}e0 AS sx, (t - ({_ORIGIN + 6_600_000.0!r}::DOUBLE - ra * cos(th))) / {_SIZE[2]}e0 AS sy FROM en JOIN ras USING (id)),
near AS (SELECT id, gx, gy, greatest(0, CAST(floor(sx - 0.5e0) AS BIGINT)) AS c0, least({_SIZE[0] - 1}, CAST(floor(sx - 0.5e0) AS BIGINT) + 1) AS c1, greatest(0, CAST(floor(sy - 0.5e0) AS BIGINT)) AS r0, least({_SIZE[1] - 1}, CAST(floor(sy - 0.5e0) AS BIGINT) + 1) AS r1,
 sx - 0.5e0 - floor(sx - 0.5e0) AS fu, sy - 0.5e0 - floor(sy - 0.5e0) AS fv FROM src WHERE sx >= 0 AND sx < {_SIZE[0]} AND sy >= 0 AND sy < {_SIZE[1]}),
val AS (SELECT id, gx, gy, CAST({_between(0)} AS BIGINT) AS b0, CAST({_between(1)} AS BIGINT) AS b1, CAST({_between(2)} AS BIGINT) AS b2 FROM near),
won AS (SELECT gx, gy, arg_max(b0, id) AS b0, arg_max(b1, id) AS b1, arg_max(b2, id) AS b2 FROM val WHERE b0 + b1 + b2 > 0 GROUP BY gx, gy)"""


@query(f"WITH {_WARPED} SELECT gx // 256 AS x, gy // 256 AS y, count(*) AS filled, CAST(sum(b0) AS BIGINT) AS s0, CAST(sum(b1) AS BIGINT) AS s1, CAST(sum(b2) AS BIGINT) AS s2 FROM won GROUP BY 1, 2")
def warped_tiles(spark, sf_dir):
    """Overlapping rasters of the conic projection as Mercator tiles: pixels and band sums of each."""
    sums = warp.warped(_scene(spark, sf_dir)).select("x", "y", raster.band_sums(F.col("pixels")).alias("b"))
    return sums.select("x", "y", "b.filled", *(F.col("b.sums")[k].alias(f"s{k}") for k in range(3)))


_CENTRES = f"mid AS (SELECT id, {_degrees_sql(f'(l + {_SIZE[0] * _SIZE[2] / 2}e0)', f'(t - {_SIZE[1] * _SIZE[2] / 2}e0)')} FROM ras)"


@query(
    f"""WITH {_WARPED}, {_CENTRES}, win AS (SELECT id, CAST(round_even({_gx('lon')} - 32, 0) AS BIGINT) AS x0, CAST(round_even({_gy('lat')} - 32, 0) AS BIGINT) AS y0 FROM mid)
SELECT win.id, count(gx) AS filled, CAST(coalesce(sum(b2), 0) AS BIGINT) AS blue, CAST(coalesce(sum(b0), 0) AS BIGINT) AS red FROM win LEFT JOIN won ON gx >= x0 AND gx < x0 + 64 AND gy >= y0 AND gy < y0 + 64 GROUP BY win.id"""
)
def world_windows(spark, sf_dir):
    """Windows round the rasters' centres, read from the bucketed table of the warped tiles."""
    w, h, res = _SIZE
    scene = _scene(spark, sf_dir)
    name = f"tiles_{uuid.uuid4().hex}"
    buckets = max(8, -(-table(spark, sf_dir, "supplier").count() // 500))  # a few dozen tiles each
    tiles.write_tiles(warp.warped(scene), name, buckets=buckets)
    lon, lat = conic.LAMBERT_93.inverse(F.col("left") + w * res / 2, F.col("top") - h * res / 2)
    points = scene.where("col = 0 and row = 0").select(F.col("ord").alias("id"), lon.alias("lon"), lat.alias("lat"))
    found = tiles.read_windows(spark.table(name), points, px=64).select("id", raster.band_sums(F.col("pixels")).alias("b"))
    return found.select("id", "b.filled", F.col("b.sums")[0].alias("blue"), F.col("b.sums")[2].alias("red"))


_LABEL_BOX = """CAST(o_orderkey % 300 AS BIGINT) AS image, CAST(o_orderkey % 3 AS INT) AS cls, CAST(o_orderkey AS BIGINT) AS ord,
  CAST(o_orderkey * 7919 % 6007 AS DOUBLE) / 10 AS x0, CAST(o_orderkey * 10007 % 6011 AS DOUBLE) / 10 AS y0, CAST(8 + o_orderkey % 23 AS DOUBLE) AS w, CAST(8 + o_orderkey % 19 AS DOUBLE) AS h"""
# Later lines lie farther off, are less certain and of another class now and then.
_PRED_BOX = """image, CAST((cls + CASE WHEN (l_partkey + l_linenumber) % 13 = 0 THEN 1 ELSE 0 END) % 3 AS INT) AS cls, ((ord * 10 + l_linenumber) * 1000000 + l_partkey) * 100000 + l_suppkey AS ord,
  x0 + w * l_linenumber * CAST(l_partkey * 31 % 21 - 10 AS DOUBLE) / 200 AS x0, y0 + h * l_linenumber * CAST(l_suppkey * 53 % 21 - 10 AS DOUBLE) / 200 AS y0,
  w * (1 + CAST(l_partkey % 9 - 4 AS DOUBLE) / 40) AS w, h * (1 + CAST(l_suppkey % 9 - 4 AS DOUBLE) / 40) AS h, CAST(l_partkey * 613 % 997 AS DOUBLE) / 997 / l_linenumber AS score"""
_EDGES_BOX = "x0, y0, x0 + w AS x1, y0 + h AS y1"
_METRICS = f"""WITH b AS (SELECT {_LABEL_BOX} FROM orders), lab AS (SELECT image, cls, ord, {_EDGES_BOX} FROM b),
p0 AS (SELECT {_PRED_BOX} FROM lineitem JOIN b ON b.ord = l_orderkey), pred AS (SELECT DISTINCT image, cls, ord, {_EDGES_BOX}, score FROM p0),
pair AS (SELECT p.image, p.cls, p.ord AS pred, l.ord AS label, p.score, greatest(0, least(p.x1, l.x1) - greatest(p.x0, l.x0)) * greatest(0, least(p.y1, l.y1) - greatest(p.y0, l.y0)) AS inter,
 (p.x1 - p.x0) * (p.y1 - p.y0) + (l.x1 - l.x0) * (l.y1 - l.y0) AS area FROM pred p JOIN lab l ON p.image = l.image AND p.cls = l.cls AND p.x0 < l.x1 AND l.x0 < p.x1 AND p.y0 < l.y1 AND l.y0 < p.y1),
best AS (SELECT * FROM (SELECT *, inter / (area - inter) AS iou, row_number() OVER (PARTITION BY image, cls, pred ORDER BY inter / (area - inter) DESC, label) AS k FROM pair) WHERE k = 1),
thr AS (SELECT i AS level, (50 + 5 * i) / 100e0 AS t FROM range(10) x(i)),
tp AS (SELECT image, cls, pred, level FROM (SELECT *, row_number() OVER (PARTITION BY image, cls, label, level ORDER BY score DESC, pred) AS q FROM best JOIN thr ON iou >= t) WHERE q = 1),
cnt AS (SELECT l.cls, n, coalesce(m, 0) AS m FROM (SELECT cls, count(*) AS n FROM lab GROUP BY cls) l LEFT JOIN (SELECT cls, count(*) AS m FROM pred GROUP BY cls) USING (cls)),
pos AS (SELECT image, cls, ord, score, row_number() OVER (PARTITION BY cls ORDER BY score DESC, image, ord) AS pos FROM pred WHERE cls IN (SELECT cls FROM cnt)),
hit AS (SELECT p.cls, thr.level, p.pos, p.score, count(tp.pred) OVER (PARTITION BY p.cls, thr.level ORDER BY p.pos) AS k FROM pos p CROSS JOIN thr LEFT JOIN tp ON tp.image = p.image AND tp.cls = p.cls AND tp.pred = p.ord AND tp.level = thr.level),
env AS (SELECT *, max(k / pos) OVER (PARTITION BY cls, level ORDER BY pos DESC) AS e FROM hit),
flat AS (SELECT cls, level, k, max_by(e, pos) AS last, min_by(e, pos) AS first FROM (SELECT cls, level, pos, k, e FROM env UNION ALL SELECT cls, level, 0, 0, 1e0 FROM cnt, thr) GROUP BY ALL),
low AS (SELECT cls, level, k, k / n AS rec, CASE WHEN k = 0 AND m = 0 THEN 0 ELSE last END AS last, lead(k / n) OVER w AS rec2, lead(first) OVER w AS high FROM flat JOIN cnt USING (cls) WINDOW w AS (PARTITION BY cls, level ORDER BY k)),
g AS (SELECT cls, level, i, i * 0.01e0 AS x FROM cnt, thr, range(101) y(i)),
val AS (SELECT g.cls, g.level, i, CASE WHEN i = 100 THEN 0 WHEN coalesce(rec2, 1) <= rec THEN last ELSE last + (x - rec) / (coalesce(rec2, 1) - rec) * (coalesce(high, 0) - last) END AS v FROM g ASOF JOIN low ON g.cls = low.cls AND g.level = low.level AND g.x >= low.rec),
ap AS (SELECT cls, level, sum(v * CASE WHEN i IN (0, 100) THEN 0.5e0 ELSE 1 END) / 100 AS ap FROM val GROUP BY cls, level),
one AS (SELECT cls, pos, score, k FROM hit WHERE level = 0), lev AS (SELECT cls, score, max(pos) AS pos, max(k) AS k FROM one GROUP BY cls, score),
cg AS (SELECT cls, n, m, i, i * (1e0 / 999) AS x FROM cnt, range(1000) y(i)),
cj AS (SELECT cg.*, lev.score AS s, lev.pos, lev.k FROM cg ASOF LEFT JOIN lev ON cg.cls = lev.cls AND cg.x <= lev.score),
cur AS (SELECT a.cls, i, CASE WHEN m = 0 THEN 0 WHEN a.pos IS NULL THEN 1 WHEN b.pos IS NULL THEN a.k / a.pos ELSE a.k / a.pos + (s - x) / (s - b.score) * (b.k / b.pos - a.k / a.pos) END AS p,
 CASE WHEN m = 0 OR a.pos IS NULL THEN 0 WHEN b.pos IS NULL THEN a.k / n ELSE a.k / n + (s - x) / (s - b.score) * (b.k / n - a.k / n) END AS r FROM cj a LEFT JOIN one b ON b.cls = a.cls AND b.pos = a.pos + 1),
f1 AS (SELECT i, avg(2 * p * r / (p + r + 1e-16)) AS f FROM cur GROUP BY i),
sm AS (SELECT c.i, round(avg(f), 12) AS f FROM (SELECT i, greatest(0, least(999, i + d - 50)) AS j FROM range(1000) y(i), range(101) z(d)) c JOIN f1 ON f1.i = c.j GROUP BY c.i),
top AS (SELECT i FROM sm ORDER BY f DESC, i LIMIT 1),
cls AS (SELECT c.cls, n AS n_labels, m AS n_preds, p, r, ap50, ap FROM cnt c JOIN (SELECT cls, p, r FROM cur JOIN top USING (i)) USING (cls) JOIN (SELECT cls, max(ap) FILTER (level = 0) AS ap50, avg(ap) AS ap FROM ap GROUP BY cls) USING (cls))"""


def _boxes(spark, sf_dir):
    """Predictions, of lines with an order, and labels.

    Both are dealt out by image, which a line's order names, so that lines meet their orders and then all boxes of an
    image without being moved again.
    """
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "1 AS known")
    lines = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS o_orderkey", "0 AS known", "l_partkey", "l_suppkey", "l_linenumber")
    image, keys = F.expr("o_orderkey % 300"), ("l_partkey", "l_suppkey", "l_linenumber")
    parts = min(300, max(1, -(-lines.count() // 50_000)))  # what is drawn from a line is far larger than it; there are 300 images
    ends = (F.expr("x0 + w").alias("x1"), F.expr("y0 + h").alias("y1"))

    def drawn(rows, *more):
        return rows.selectExpr("image", f"struct({_LABEL_BOX}) AS b", *more).select("image", *(f"b.{c}" for c in ("cls", "ord", "x0", "y0", "w", "h")), *more)

    met = lines.unionByName(orders, allowMissingColumns=True).repartition(parts, image).select(image.alias("image"), "*")
    met = met.withColumn("met", F.max("known").over(Window.partitionBy("image", "o_orderkey"))).where("known = 0 and met = 1")
    predictions = drawn(met, *keys).selectExpr("image", f"struct({_PRED_BOX}) AS p").select("image", *(f"p.{c}" for c in ("cls", "ord", "x0", "y0", "w", "h", "score")))
    labels = drawn(orders.repartition(parts, image).select(image.alias("image"), "o_orderkey"))
    return predictions.select("image", "cls", "ord", "x0", "y0", *ends, "score"), labels.select("image", "cls", "ord", "x0", "y0", *ends)


@query(f"{_METRICS} SELECT cls, n_labels, n_preds, round(p, 6) AS precision, round(r, 6) AS recall, round(ap50, 6) AS ap50, round(ap, 6) AS ap FROM cls")
def class_metrics(spark, sf_dir):
    """Precision, recall and average precision of each class."""
    found = metrics.by_class(*_boxes(spark, sf_dir))
    return found.select("cls", "n_labels", "n_preds", *(r(F.col(c), 6).alias(c) for c in ("precision", "recall", "ap50", "ap")))


@query(f"{_METRICS} SELECT round(avg(p), 6) AS mp, round(avg(r), 6) AS mr, round(avg(ap50), 6) AS map50, round(avg(ap), 6) AS map, CASE WHEN avg(ap50) >= 0.6e0 THEN 'ATTEINT' ELSE 'NON ATTEINT' END AS verdict FROM cls")
def detection_metrics(spark, sf_dir):
    """Means over the classes, and whether the goal is reached."""
    found = metrics.summary(metrics.by_class(*_boxes(spark, sf_dir)))
    return found.select(*(r(F.col(c), 6).alias(c) for c in ("mp", "mr", "map50", "map")), "verdict")


@query(
    f"""WITH {BASE}, t AS (SELECT DISTINCT {_TILE} FROM assets), k AS (SELECT '19_' || x || '_' || y || '.jpg' AS key, x, y FROM t)
SELECT key, CASE WHEN (x + y) % 3 = 0 THEN 'hit' WHEN (x + 2 * y) % 5 = 0 THEN 'failed' ELSE 'fetched' END AS status, CASE WHEN (x + y) % 3 = 0 OR (x + 2 * y) % 5 > 0 THEN md5('tile ' || x || ' ' || y) END AS content FROM k"""
)
def tile_fetch(spark, sf_dir):
    """Tiles through a cache table: a third is there, the rest is asked of a session, and a fifth of that always fails."""
    x, y = geo.tile_of(F.col("lon"), F.col("lat"))
    sought = assets(spark, sf_dir).select(x.alias("x"), y.alias("y"), geo.tile_key(x, y, F.lit("A"), "A").alias("key"), geo.tile_url(x, y, "{x} {y}", "A").alias("url"))
    name = f"tile_cache_{uuid.uuid4().hex}"

    def session():
        def get(url):
            x, y = map(int, url.split())
            if (x + 2 * y) % 5 == 0 and (x + y) % 3:
                raise OSError("lost")
            return f"tile {url}".encode()

        return get

    fetch.prefetch(sought.where("(x + y) % 3 = 0"), name, session).count()
    status = fetch.prefetch(sought, name, session, fetch.Retry(2, 0.0))
    return fetch.contents(status, name).select("key", "status", F.md5("content").alias("content"))


@query(
    f"""WITH g AS ({_GREY}), f AS (SELECT * FROM g ORDER BY id LIMIT 48), p AS (SELECT i, greatest(0, (i + 0.5e0) * 0.1875e0 - 0.5e0) AS u FROM range(128) x(i)),
v AS (SELECT CASE WHEN floor(u) < 11 THEN a WHEN floor(u) >= 12 THEN b ELSE floor(a * (1 - (u - 11)) + b * (u - 11) + 0.5e0) END AS v FROM f, p)
SELECT CAST(ceil((SELECT count(*) FROM f) / 8) * 128 AS INTEGER) AS height, 1024 AS width, CAST(sum(v) * 128 AS BIGINT) + 50 * 16384 * ((8 - (SELECT count(*) FROM f) % 8) % 8) AS total FROM v"""
)
def contact_sheet(spark, sf_dir):
    """A contact sheet of 48 slots: its size and the sum of its pixels."""
    crops = _grey(spark, sf_dir).withColumnRenamed("id", "ord").withColumns({k: F.lit(None).cast("double") for k in ("x0", "y0", "x1", "y1")})
    return sinks.contact_sheet(crops).select("height", "width", raster.band_sums(F.col("pixels")).alias("b")).select("height", "width", F.col("b.sums")[0].alias("total"))


_SAID = "SELECT user_id % 500 AS key, event_id % 40 AS event, CASE event_id % 5 WHEN 0 THEN 'undo' WHEN 1 THEN 'faux' WHEN 2 THEN 'skip' ELSE 'vrai' END AS verdict, event_id * 7919 % 1009 AS ts FROM events"


@query(
    f"""WITH e AS (SELECT key, event, min({{'ts': ts, 'verdict': verdict}}) AS e FROM ({_SAID}) GROUP BY key, event), f AS (SELECT key, event, e.ts AS ts, e.verdict AS verdict FROM e),
w AS (SELECT *, coalesce(sum(CASE WHEN verdict = 'undo' THEN 1 ELSE -1 END) OVER (PARTITION BY key ORDER BY ts DESC, event DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open FROM f)
SELECT key, s.verdict AS verdict, s.ts AS at, events FROM (SELECT key, max({{'ts': ts, 'event': event, 'verdict': verdict}}) FILTER (verdict <> 'undo' AND open <= 0) AS s, count(*) AS events FROM w GROUP BY key)"""
)
def standing_verdicts(spark, sf_dir):
    """Verdicts that stand after undos, from repeated and unordered events."""
    e = table(spark, sf_dir, "events").selectExpr("user_id % 500 AS key", "event_id % 40 AS event", "CASE event_id % 5 WHEN 0 THEN 'undo' WHEN 1 THEN 'faux' WHEN 2 THEN 'skip' ELSE 'vrai' END AS verdict", "event_id * 7919 % 1009 AS ts")
    return review.standing_verdicts(e)

"""Train, validation and test splits, record numbering and samples."""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._rows import numbered, running_sums

RATIOS = (0.7, 0.15, 0.15)


def shuffle_key(seed: int, *parts: Column) -> Column:
    """A seeded order that any engine with md5 reproduces."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(p.cast("string") for p in parts)))


#: Things that Python's generator shuffles at most; it has no other way than one by one.
EXACT = 1_000_000


def generator_places(spark: SparkSession, n: int, seed: int) -> DataFrame:
    """(k, place): where Python's generator with this seed puts each of n things, 0 to n - 1, when it shuffles them."""
    if n > EXACT:
        raise ValueError(f"over {EXACT} things to shuffle: use the seeded order")
    order = list(range(n))
    random.Random(seed).shuffle(order)
    return spark.createDataFrame(pa.table({"k": pa.array(order, pa.int64()), "place": pa.array(range(n), pa.int64())}))


def spatial_split(points: DataFrame, cell_deg: float = 0.05, seed: int = 0, ratios: tuple[float, float, float] = RATIOS, exact: bool = False) -> DataFrame:
    """``points`` (id, lon, lat) with part: whole cells, so that no two parts share one.

    Cells are taken in seeded order while the points before them are fewer than the part's share.  ``exact`` takes them
    as Python's generator shuffles the sorted cells, of which there are ``EXACT`` at most.
    """
    cells = points.withColumns({"cx": F.floor(F.col("lon") / cell_deg), "cy": F.floor(F.col("lat") / cell_deg)})
    per = cells.groupBy("cx", "cy").agg(F.count("*").alias("n"))
    order = [shuffle_key(seed, F.col("cx"), F.col("cy")), F.col("cx"), F.col("cy")]
    if exact:
        known = numbered(per, "k", F.col("cx"), F.col("cy"))
        per, order = known.join(generator_places(points.sparkSession, known.count(), seed), "k").drop("k"), [F.col("place")]
    placed = running_sums(per, {"before": F.col("n")}, *order)
    total = points.count()
    part = F.when(F.col("before") < total * ratios[0], "train").when(F.col("before") < total * ratios[0] + total * ratios[1], "val").otherwise("test")
    return cells.join(placed.select("cx", "cy", part.alias("part")), ["cx", "cy"]).drop("cx", "cy")


def random_split(rows: DataFrame, id_col: str = "id", seed: int = 0, ratios: tuple[float, float, float] = RATIOS, exact: bool = False) -> DataFrame:
    """``rows`` with part by seeded order: the first int(ratio * n) train, then val, the rest test.

    ``exact`` takes the order in which Python's generator shuffles the rows, numbered by their ids; ``EXACT`` at most.
    """
    n = rows.count()
    a, b = int(n * ratios[0]), int(n * ratios[1])
    if exact:
        placed = numbered(rows, "_k", F.col(id_col)).join(generator_places(rows.sparkSession, n, seed).select(F.col("k").alias("_k"), F.col("place").alias("_place")), "_k").drop("_k")
    else:
        placed = numbered(rows, "_place", shuffle_key(seed, F.col(id_col)), F.col(id_col))
    return placed.withColumn("part", F.when(F.col("_place") < a, "train").when(F.col("_place") < a + b, "val").otherwise("test")).drop("_place")


def sample_if_more(rows: DataFrame, most: int, id_col: str = "id", seed: int = 0) -> DataFrame:
    """``most`` rows without replacement in seeded order; all rows if there are no more."""
    return rows.orderBy(shuffle_key(seed, F.col(id_col)), F.col(id_col)).limit(most)


def part_lists(split: DataFrame, id_col: str = "id") -> DataFrame:
    """(part, place, id): each part's rows in the order of their ids, places from 0 in each part."""
    placed = numbered(split, "_place", F.col("part"), F.col(id_col))
    first = placed.groupBy("part").agg(F.min("_place").alias("_first"))
    return placed.join(F.broadcast(first), "part").select("part", (F.col("_place") - F.col("_first")).alias("place"), id_col)  # one row a part


def empty_parts(split: DataFrame, parts: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """(part): those without a row."""
    wanted = split.sparkSession.createDataFrame([(p,) for p in parts], "part string")
    return wanted.join(split.select("part").distinct(), "part", "left_anti")


def first_rows(rows: DataFrame, most: int, order: str = "ord") -> DataFrame:
    """The first ``most`` rows of the original order."""
    return rows.orderBy(order).limit(most)


def without_positions(rows: DataFrame, positions: list[int], order: str = "ord") -> DataFrame:
    """``rows`` without those at the given positions of the original order."""
    return numbered(rows, "_place", F.col(order)).where(~F.col("_place").isin(positions)).drop("_place") if positions else rows


def background_points(spark, n: int, w: float, s: float, e: float, north: float, seed: int = 0) -> DataFrame:
    """``n`` seeded points in a box: ord, lon, lat."""
    unit = lambda c: F.conv(F.substring(shuffle_key(seed, F.lit(c), F.col("id")), 1, 8), 16, 10).cast("double") / 2**32
    return spark.range(n).select(F.col("id").alias("ord"), (F.lit(w) + unit("lon") * (e - w)).alias("lon"), (F.lit(s) + unit("lat") * (north - s)).alias("lat"))


def named_records(sources: dict[str, DataFrame]) -> DataFrame:
    """The union of sources (ord, lon, lat, bbox) in their order, each row named by its source and its number there."""
    out = None
    for i, (name, rows) in enumerate(sources.items()):
        n = numbered(rows, "number", F.col("ord")).select(F.lit(i).alias("source_rank"), "ord", F.concat(F.lit(f"{name}_"), F.format_string("%04d", "number")).alias("name"), "lon", "lat", "bbox")
        out = n if out is None else out.unionByName(n)
    return out

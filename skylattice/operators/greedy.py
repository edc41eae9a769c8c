"""Order-exact greedy operators as rounds over candidate pairs.

Dedup keeps, by falling score and then rising ``ord``, each point with no kept point within the radius: the
lexicographically first maximal independent set.  Matching gives each detection, in the same order, the nearest
free reference point (the last ``ord`` on equal distance).  A pair is settled as soon as nothing that comes
before it is undecided at either end; rounds repeat until no pair is left.  A missing score counts as 0.0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._rows import checkpointed
from . import distance
from .distance import pairs_within


def dedup(points: DataFrame, radius_m: float) -> DataFrame:
    """The kept rows of ``points`` (ord unique, lon, lat, score); those without a place are kept.

    Of points on one spot only the first can be kept, as whatever drops it drops the others, so a crowded spot makes
    no pairs of its own.
    """
    placed = F.col("lon").isNotNull() & F.col("lat").isNotNull() & ~F.isnan("lon") & ~F.isnan("lat")
    turn = (-F.coalesce("score", F.lit(0.0))).alias("turn")
    spots = checkpointed(points.where(placed).groupBy("lon", "lat").agg(F.min(F.struct(turn, "ord")).alias("first")).select("first.ord", "lon", "lat", "first.turn"))
    both = pairs_within(spots, spots, radius_m).where(F.struct("l.turn", "l.ord") < F.struct("r.turn", "r.ord"))
    edges = checkpointed(both.select(F.col("l.ord").alias("first"), F.col("r.ord").alias("then")))
    dropped = None
    while not edges.isEmpty():
        waiting = edges.select(F.col("then").alias("first")).distinct()
        kept = edges.select("first").distinct().join(waiting, "first", "left_anti")
        out = checkpointed(edges.join(kept, "first", "left_semi").select(F.col("then").alias("ord")).distinct())
        dropped = out if dropped is None else dropped.union(out)
        edges = edges.join(kept, "first", "left_anti").join(out.select(F.col("ord").alias("first")), "first", "left_anti")
        edges = checkpointed(edges.join(out.select(F.col("ord").alias("then")), "then", "left_anti"))
    heads = spots.select("ord") if dropped is None else spots.select("ord").join(dropped, "ord", "left_anti")
    return points.join(heads, "ord", "left_semi").select(*points.columns).union(points.where(~placed))


def matches(dets: DataFrame, refs: DataFrame, radius_m: float) -> DataFrame:
    """(det, ref, dist): ords of the one-to-one pairs."""
    d = dets.select("ord", "lon", "lat", (-F.coalesce("score", F.lit(0.0))).alias("turn"))
    near = pairs_within(d, refs.select("ord", "lon", "lat"), radius_m)
    edges = checkpointed(near.select(F.col("l.ord").alias("det"), F.col("r.ord").alias("ref"), "dist", F.struct(F.col("l.turn").alias("turn"), F.col("l.ord").alias("ord"), "dist", (-F.col("r.ord")).alias("last")).alias("key")))
    done = None
    while not edges.isEmpty():
        by_det, by_ref = (edges.groupBy(c).agg(F.min("key").alias("key")) for c in ("det", "ref"))
        now = checkpointed(edges.join(by_det, ["det", "key"], "left_semi").join(by_ref, ["ref", "key"], "left_semi").select("det", "ref", "dist"))
        done = now if done is None else done.union(now)
        edges = checkpointed(edges.join(now.select("det"), "det", "left_anti").join(now.select("ref"), "ref", "left_anti"))
    return edges.select("det", "ref", "dist") if done is None else done


def match(dets: DataFrame, refs: DataFrame, radius_m: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(matched with det, ref, dist; unmatched dets; unmatched refs)."""
    found = matches(dets, refs, radius_m)
    return found, _free(dets, found.select(F.col("det").alias("ord"))), _free(refs, found.select(F.col("ref").alias("ord")))


def _free(points: DataFrame, taken: DataFrame) -> DataFrame:
    """``points`` whose ord isn't taken; dealt out by rows, as bare ords pack so well that partitions of so many bytes hold millions."""
    parts = max(1, -(-points.count() // distance.ROWS))
    return points.repartition(parts, "ord").join(taken.repartition(parts, "ord"), "ord", "left_anti").select(*points.columns)

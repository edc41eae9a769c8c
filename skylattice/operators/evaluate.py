"""Reports over verdicts, thresholds and reviews; each but the sweep is one grouped aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._rows import running_sums
from .distance import exists_within

#: Fixed verdict values of review files.
TRUE, FALSE, UNREVIEWED = "vrai", "faux", "non_revu"


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0.0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def verdict_report(dets: DataFrame, verdicts: DataFrame, radius_m: float) -> DataFrame:
    """One row: false and true points in all, those that a detection is still near, and the number of detections.  verdicts: id, lon, lat, verdict."""
    near = exists_within(verdicts, dets, radius_m).select("id", F.lit(True).alias("near"))
    marked = verdicts.join(near, "id", "left").withColumn("near", F.coalesce("near", F.lit(False)))
    n = lambda c: F.count_if(c)
    false, true = F.col("verdict") == FALSE, F.col("verdict") == TRUE
    counts = marked.agg(n(false).alias("fp_total"), n(false & F.col("near")).alias("fp_still"), n(false & ~F.col("near")).alias("fp_suppressed"), n(true).alias("tp_total"), n(true & F.col("near")).alias("tp_kept"))
    return counts.crossJoin(dets.agg(F.count("*").alias("n_candidates_new")))  # one row each


def field_report(points: DataFrame) -> DataFrame:
    """One row from points (verdict, fired, skip): suppressed false and kept true points; skipped ones don't count."""
    seen = points.where(~F.coalesce("skip", F.lit(False)))
    false, true = F.col("verdict") == FALSE, F.col("verdict") == TRUE
    return seen.agg(F.count_if(false).alias("fp_total"), F.count_if(false & ~F.col("fired")).alias("fp_suppressed"), F.count_if(true).alias("tp_total"), F.count_if(true & F.col("fired")).alias("tp_kept"))


def thresholds(spark, least: float = 0.05, most: float = 0.9, step: float = 0.05) -> DataFrame:
    n = int((most - least) / step + 1e-9) + 1
    return spark.range(n).select(F.round(F.lit(least) + F.col("id") * step, 4).alias("conf"))


def sweep(scored: DataFrame, confs: DataFrame) -> DataFrame:
    """(conf, precision, recall, tp, fp) of scored (score, is_true); a score equal to the threshold fires.

    Scores and thresholds stand in one falling order of distinct values; a running sum over its ranges counts what fires at each.
    """
    per_score = scored.groupBy(F.col("score").cast("double").alias("_v")).agg(F.count_if("is_true").alias("t"), F.count_if(~F.col("is_true")).alias("f"))
    asked = confs.select(F.col("conf").cast("double").alias("_v"), F.lit(0).cast("bigint").alias("t"), F.lit(0).cast("bigint").alias("f"))
    values = per_score.union(asked).where("_v is not null").groupBy("_v").agg(F.sum("t").alias("t"), F.sum("f").alias("f"))
    before = running_sums(values, {"tp": F.col("t"), "fp": F.col("f")}, F.desc("_v"))
    sums = before.select("_v", (F.col("tp") + F.col("t")).alias("tp"), (F.col("fp") + F.col("f")).alias("fp"))
    full = confs.withColumn("_v", F.col("conf").cast("double")).join(sums, "_v", "left").fillna(0, ["tp", "fp"])
    full = full.crossJoin(scored.agg(F.count_if("is_true").alias("all_true")))  # one row
    return full.select("conf", ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), ratio(F.col("tp"), F.col("all_true")).alias("recall"), "tp", "fp")


def recall(matched: DataFrame, refs: DataFrame) -> DataFrame:
    """(matched, total, recall); recall is null without reference points."""
    m = matched.agg(F.count("*").alias("matched")).crossJoin(refs.agg(F.count("*").alias("total")))
    return m.withColumn("recall", F.try_divide(F.col("matched").cast("double"), F.col("total")))


def review_key(lat: Column, lon: Column) -> Column:
    return F.format_string("%.6f,%.6f", lat, lon)


def review_export(candidates: DataFrame, state: DataFrame) -> DataFrame:
    """(index from 1, lat, lon, score, verdict) as text; candidates (ord, lon, lat, score), state (key, verdict)."""
    joined = candidates.withColumn("key", review_key(F.col("lat"), F.col("lon"))).join(state.select("key", "verdict"), "key", "left")
    return joined.select((F.col("ord") + 1).alias("index"), F.format_string("%.6f", "lat").alias("lat"), F.format_string("%.6f", "lon").alias("lon"), F.coalesce(F.when(F.col("score").isNotNull(), F.format_string("%.3f", "score")), F.lit("")).alias("score"), F.coalesce("verdict", F.lit(UNREVIEWED)).alias("verdict"))


def review_counters(candidates: DataFrame, state: DataFrame) -> DataFrame:
    """One row: true, false, skipped, left, and the first candidate without a verdict (0 if none)."""
    joined = candidates.withColumn("key", review_key(F.col("lat"), F.col("lon"))).join(state.select("key", "verdict"), "key", "left")
    v = F.col("verdict")
    return joined.agg(F.count_if(v == TRUE).alias("vrai"), F.count_if(v == FALSE).alias("faux"), F.count_if(v == "skip").alias("skip"), F.count_if(v.isNull() | ~v.isin(TRUE, FALSE, "skip")).alias("reste"), F.coalesce(F.min(F.when(v.isNull(), F.col("ord"))), F.lit(0)).alias("first_open"))


def tag_histogram(rows: DataFrame) -> DataFrame:
    """(tag, n, first) of rows (ord, tags): counts of key=value, most frequent first and ties as first seen."""
    tags = rows.select("ord", F.posexplode(F.map_entries("tags")).alias("pos", "e"))
    return tags.groupBy(F.concat_ws("=", "e.key", "e.value").alias("tag")).agg(F.count("*").alias("n"), F.min(F.struct("ord", "pos")).alias("_first")).orderBy(F.desc("n"), "_first").select("tag", "n", F.col("_first.ord").alias("first"))


def hsv_bounds(samples: DataFrame, margin: tuple[int, int, int] = (5, 30, 30)) -> DataFrame:
    """Per channel of samples (h, s, v): min, p10, median, p90, max and calibrated bounds p10 - margin and p90 + margin, clipped and truncated."""
    tops = {"h": 179, "s": 255, "v": 255}
    long = samples.select(F.explode(F.array(*(F.struct(F.lit(c).alias("channel"), F.col(c).cast("double").alias("value"), F.lit(float(top)).alias("top"), F.lit(m).alias("margin")) for (c, top), m in zip(tops.items(), margin)))).alias("x")).select("x.*")
    # Values are counted first: a channel of 8 bits has 256 at most.
    counted = long.where("value is not null").groupBy("channel", "top", "margin", "value").agg(F.count("*").alias("n"))
    p = F.percentile("value", F.array(*map(F.lit, (0.0, 0.1, 0.5, 0.9, 1.0))), F.col("n"))
    q = counted.groupBy("channel", "top", "margin").agg(p.alias("p")).select("channel", "top", "margin", *(F.col("p")[i].alias(n) for i, n in enumerate(("low", "p10", "median", "p90", "high"))))
    return q.withColumns({"lower": F.greatest(F.lit(0.0), F.col("p10") - F.col("margin")).cast("int"), "upper": F.least(F.col("top"), F.col("p90") + F.col("margin")).cast("int")}).drop("top", "margin")


def window_counters(boxes: DataFrame) -> DataFrame:
    """One row: windows seen, failed (an error) and fired (a box) of predicted boxes (id, score, error)."""
    per = boxes.groupBy("id").agg(F.bool_or(F.col("error").isNotNull()).alias("failed"), F.bool_or(F.col("score").isNotNull()).alias("fired"))
    return per.agg(F.count("*").alias("windows"), F.count_if("failed").alias("failed"), F.count_if("fired").alias("fired"))


def true_positives(candidates: DataFrame, state: DataFrame) -> DataFrame:
    """``candidates`` (ord, lon, lat, ...) that were reviewed as true, with their verdict."""
    keyed = candidates.withColumn("_key", review_key(F.col("lat"), F.col("lon")))
    found = state.where(F.col("verdict") == TRUE).select(F.col("key").alias("_key"), "verdict")
    return keyed.join(found, "_key").drop("_key")


def review_size(layers: DataFrame, review: list[str]) -> DataFrame:
    """One row: the features (layer, ...) of the layers that are up for review."""
    return layers.agg(F.count_if(F.col("layer").isin(*review)).alias("n_review"))

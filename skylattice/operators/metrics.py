"""Precision, recall and average precision of predicted boxes against labelled ones.

A prediction belongs to the label that it overlaps most; of a label's predictions the most confident one is right, at
each overlap threshold by itself.  The boxes of an image meet in one task, which looks for a box's label only
among those whose size and middle may fit, the nearest first.  What is right at which threshold are the bits of one
number, so a prediction is moved once more only, to its place in the order of confidence; from there on thousands of
predictions make one row.  The curves are only needed at a fixed number of places, so what lies between two of them is
aggregated first, and the envelope, a running maximum from the right, runs over those few.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ._rows import checkpointed, written

#: Overlap thresholds, recall places of the average, confidence places of the curves and of their smoothing, and the goal.
THRESHOLDS = tuple(round(0.5 + 0.05 * i, 2) for i in range(10))
RECALLS, CONFIDENCES, SMOOTH = 101, 1000, 50
GOAL, REACHED, MISSED = 0.60, "ATTEINT", "NON ATTEINT"

BOX = ("x0", "y0", "x1", "y1")
#: Predictions that are compared together, and pairs of boxes; all pairs are made where they are no more than ``FEW``.  Predictions that a task sorts.
TOGETHER, PAIRS, FEW, SORTED = 1 << 14, 1 << 18, 1 << 14, 250_000


def overlap(a: list[Column], b: list[Column]) -> Column:
    """Intersection over union of two boxes (x0, y0, x1, y1)."""
    side = lambda i: F.greatest(F.lit(0.0), F.least(a[i + 2], b[i + 2]) - F.greatest(a[i], b[i]))
    area = lambda c: (c[2] - c[0]) * (c[3] - c[1])
    shared = side(0) * side(1)
    return shared / (area(a) + area(b) - shared)


def _cells(low: Column, high: Column, least: float) -> Column:
    """Level and cell on one axis of all intervals that may overlap this one by ``least`` of the longer of both.

    Such an interval's length is within a factor of 1 / least, and its middle within (1 - least) of the longer length.
    """
    size, middle = high - low, (low + high) / 2
    levels = F.sequence(F.floor(F.log2(size * least) - 1e-9), F.floor(F.log2(size / least) + 1e-9))

    def at(level: Column) -> Column:
        cell = F.pow(F.lit(2.0), level + 1)
        reach = F.greatest(size, F.least(cell, size / least)) * (1 - least) * (1 + 1e-9)
        return F.transform(F.sequence(F.floor((middle - reach) / cell), F.floor((middle + reach) / cell)), lambda c: F.struct(level.alias("level"), c.alias("cell")))

    return F.flatten(F.transform(levels, at))


def _own_cell(low: Column, high: Column) -> Column:
    level = F.floor(F.log2(high - low))
    return F.struct(level.alias("level"), F.floor((low + high) / 2 / F.pow(F.lit(2.0), level + 1)).alias("cell"))


def overlapping(predictions: DataFrame, labels: DataFrame, least: float = THRESHOLDS[0]) -> DataFrame:
    """(image, cls, pred, label, iou): pairs of one image and class whose overlap is ``least`` or more; both have image, cls, ord and a box.

    A label enters a few dozen cells at most, a prediction one, and each pair meets once.  Boxes without area meet none.
    """
    solid = lambda df: df.where("x1 > x0 and y1 > y0")
    placed = solid(predictions).select("image", "cls", F.col("ord").alias("pred"), *BOX, _own_cell(F.col("x0"), F.col("x1")).alias("cx"), _own_cell(F.col("y0"), F.col("y1")).alias("cy"))
    spread = solid(labels).select("image", "cls", F.col("ord").alias("label"), *(F.col(c).alias(f"l_{c}") for c in BOX))
    spread = spread.withColumn("cx", F.explode(_cells(F.col("l_x0"), F.col("l_x1"), least))).withColumn("cy", F.explode(_cells(F.col("l_y0"), F.col("l_y1"), least)))
    iou = overlap([F.col(c) for c in BOX], [F.col(f"l_{c}") for c in BOX])
    # Spark takes the cells for as small as the labels that they come from, and would collect them for a broadcast.
    return placed.join(spread.hint("merge"), ["image", "cls", "cx", "cy"]).select("image", "cls", "pred", "label", iou.alias("iou")).where(F.col("iou") >= least)


def _ranges(start: np.ndarray, stop: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, number) of all numbers from start to stop of each row, about ``PAIRS`` at a time."""
    count = np.maximum(stop - start, 0)
    ends = np.cumsum(count)
    cuts = np.searchsorted(ends, np.arange(PAIRS, ends[-1] + PAIRS, PAIRS), "right") if ends.size else []
    at = 0
    for cut in [*cuts, ends.size]:
        cut = max(cut, min(at + 1, ends.size))
        if cut > at:
            n = count[at:cut]
            row = np.repeat(np.arange(at, cut), n)
            yield row, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + start[row]
            at = cut


class _Labels:
    """Solid labels of one image and class, in grids by size."""

    def __init__(self, boxes: np.ndarray, least: float):
        self.boxes, self.least = boxes, least
        self.size, self.middle = boxes[:, 2:] - boxes[:, :2], (boxes[:, :2] + boxes[:, 2:]) / 2
        self.area = self.size[:, 0] * self.size[:, 1]
        levels = np.floor(np.log2(self.size)).astype(np.int64)
        kinds, at = np.unique(levels, axis=0, return_inverse=True)
        at = at.reshape(-1)
        self.kinds = [(kind, np.flatnonzero(at == i)) for i, kind in enumerate(kinds)]
        room = np.maximum(np.ptp(self.middle, axis=0), self.size.mean(axis=0)) if len(boxes) else np.ones(2)
        # Overlaps that are sought first: a narrow look spares a wide one wherever there is something to find.
        near = lambda t: len(boxes) * np.prod(np.minimum(1.0, 2 * (1 - t) * self.size.mean(axis=0) / room)) > 2
        self.steps = [*(t for t in (1 - (1 - least) / 4, 1 - (1 - least) / 2) if len(boxes) and near(t)), least]
        self.grids = {t: [self._grid(t, kind, some) for kind, some in self.kinds] for t in self.steps}

    def _grid(self, least: float, kind: np.ndarray, some: np.ndarray):
        """Labels of one size sorted by cell, with each cell's start; cells are no more than the labels, about."""
        low, room = self.middle[some].min(axis=0), np.ptp(self.middle[some], axis=0)
        cell = np.maximum(np.exp2(kind) * (1 - least) / 1.5, room / max(1.0, 2 * np.sqrt(len(some))))
        n = np.floor(room / cell).astype(np.int64) + 1
        c = np.minimum(np.floor((self.middle[some] - low) / cell).astype(np.int64), n - 1)
        key = c[:, 1] * n[0] + c[:, 0]
        order = np.argsort(key, kind="stable")
        return kind, some[order], low, cell, n, np.searchsorted(key[order], np.arange(n[0] * n[1] + 1))

    def best(self, boxes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each solid box the label that it overlaps most, the first of equal ones, or -1, and the overlap, if that is ``least`` or more."""
        at, iou = np.full(len(boxes), -1), np.zeros(len(boxes))
        if not len(self.boxes):
            return at, iou
        for i in range(0, len(boxes), TOGETHER):
            part = slice(i, i + TOGETHER)
            if len(self.boxes) * len(boxes) <= FEW:
                mine, theirs = np.divmod(np.arange(len(boxes) * len(self.boxes)), len(self.boxes))
                self._offer(boxes, mine, theirs, at, iou)
                continue
            for least, looked in zip(self.steps, [np.inf, *self.steps]):
                open_ = np.flatnonzero(iou[part] < looked)  # a label of more overlap than the last look's can't have been missed
                found, over = at[part][open_], iou[part][open_]
                self._look(boxes[part][open_], least, found, over)
                at[i + open_], iou[i + open_] = found, over
        return at, iou

    def _look(self, boxes: np.ndarray, least: float, at: np.ndarray, iou: np.ndarray) -> None:
        """Compares boxes with all labels that they may overlap by ``least``.

        Such a label's sides are within a factor of 1 / least, and its middle within (1 - least) of the box's side, or
        (1 - least) / (2 least) if that is more.
        """
        size, middle = boxes[:, 2:] - boxes[:, :2], (boxes[:, :2] + boxes[:, 2:]) / 2
        reach = size * ((1 - least) * max(1.0, 0.5 / least) * (1 + 1e-9)) + 1e-12 * np.abs(middle)
        for kind, order, low, cell, n, start in self.grids[least]:
            fits = ((size >= np.exp2(kind) * least * (1 - 1e-9)) & (size <= np.exp2(kind + 1) / least * (1 + 1e-9))).all(axis=1)
            a, b = np.floor((middle - reach - low) / cell), np.floor((middle + reach - low) / cell)
            mine = np.flatnonzero(fits & (b >= 0).all(axis=1) & (a < n).all(axis=1))
            a, b = np.maximum(a[mine], 0).astype(np.int64), np.minimum(b[mine], n - 1).astype(np.int64)
            for line, row in _ranges(a[:, 1], b[:, 1] + 1):
                for r, j in _ranges(start[row * n[0] + a[line, 0]], start[row * n[0] + b[line, 0] + 1]):
                    self._offer(boxes, mine[line[r]], order[j], at, iou)

    def _offer(self, boxes: np.ndarray, mine: np.ndarray, theirs: np.ndarray, at: np.ndarray, iou: np.ndarray) -> None:
        p, q = boxes[mine].T, self.boxes[theirs].T
        shared = np.maximum(np.minimum(p[2], q[2]) - np.maximum(p[0], q[0]), 0.0) * np.maximum(np.minimum(p[3], q[3]) - np.maximum(p[1], q[1]), 0.0)
        over = shared / ((p[2] - p[0]) * (p[3] - p[1]) + self.area[theirs] - shared)
        some = np.flatnonzero(over >= np.maximum(self.least, iou[mine]))
        mine, theirs, over = mine[some], theirs[some], over[some]
        order = np.lexsort((theirs, -over, mine))
        order = order[np.flatnonzero(np.diff(mine[order], prepend=-1))]
        mine, theirs, over = mine[order], theirs[order], over[order]
        won = (over > iou[mine]) | (theirs < at[mine])
        at[mine[won]], iou[mine[won]] = theirs[won], over[won]


def _solid(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The boxes of a table, and which of them have an area."""
    boxes = np.column_stack([t[c].to_numpy() for c in BOX]).astype(np.float64)
    return boxes, np.isfinite(boxes).all(axis=1) & (boxes[:, 2] > boxes[:, 0]) & (boxes[:, 3] > boxes[:, 1])


def _judge(thresholds: tuple[float, ...], fields: pa.Schema):
    """The predictions of one image, by class in the order of confidence, with the thresholds at which each is right as bits."""

    def of_class(predictions: pa.Table, labels: pa.Table) -> pa.Table:
        ords, first = np.unique(predictions["ord"].to_numpy(), return_index=True)
        predictions, labels = predictions.take(first), labels.take(np.unique(labels["ord"].to_numpy(), return_index=True)[1])
        (boxes, solid), (theirs, known) = _solid(predictions), _solid(labels)
        at, iou = np.full(len(ords), -1), np.zeros(len(ords))
        at[solid], iou[solid] = _Labels(theirs[known], min(thresholds)).best(boxes[solid])
        order = np.lexsort((ords, -predictions["score"].to_numpy()))  # the most confident first, and of equal ones the smaller
        at, iou, right = at[order], iou[order], np.zeros(len(ords), np.int32)
        for i, t in enumerate(thresholds):
            some = np.flatnonzero((at >= 0) & (iou >= t))
            right[some[np.unique(at[some], return_index=True)[1]]] |= 1 << i
        return pa.Table.from_arrays([*(predictions[c].take(order) for c in ("cls", "image", "ord", "score")), pa.array(right)], schema=fields)

    def judge(predictions: pa.Table, labels: pa.Table) -> pa.Table:
        own = lambda t, cls: t.filter(pc.equal(t["cls"], cls))
        return pa.concat_tables([fields.empty_table(), *(of_class(own(predictions, cls), own(labels, cls)) for cls in predictions["cls"].unique())])

    return judge


def _known(boxes: DataFrame) -> DataFrame:
    return boxes.where("image is not null and cls is not null and ord is not null")


def judged(predictions: DataFrame, labels: DataFrame, thresholds: tuple[float, ...] = THRESHOLDS) -> DataFrame:
    """(cls, image, ord, score, right): predictions with the numbers of the thresholds at which they are right as bits.

    Equal overlaps go to the label of smaller ord, equal scores to the prediction of smaller ord.  Predictions without
    a score go, as do rows without image, class or ord; of rows of one image, class and ord, which are repeats, one stays.
    What is dealt out by image before isn't moved again.
    """
    known = _known(predictions).where("score is not null").select("image", "cls", F.col("ord").cast("bigint"), *BOX, F.col("score").cast("double"))
    against = _known(labels).select("image", "cls", F.col("ord").cast("bigint"), *BOX)
    out = known.select("cls", "image", "ord", "score", F.lit(0).alias("right")).schema
    judge = _judge(thresholds, to_arrow_schema(out))
    return known.groupBy("image").cogroup(against.groupBy("image")).applyInArrow(judge, out)


def _runs(thresholds: int, fields: pa.Schema):
    """Sorted predictions of one range as rows of thousands: a class's next ``n``, their scores and bits, and how many are right at each threshold."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for b in batches:
            change = np.flatnonzero(np.array(pc.not_equal(b["cls"][1:], b["cls"][:-1]))) + 1 if b.num_rows > 1 else []
            for start, stop in zip([0, *change], [*change, b.num_rows]):
                if stop > start:
                    some = b.slice(start, stop - start)
                    right = some["right"].to_numpy()
                    hits = [int((right >> i & 1).sum()) for i in range(thresholds)]
                    row = [some["range"][:1], [at], some["cls"][:1], [some.num_rows], [some["score"].to_numpy()], [right], [hits]]
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) if isinstance(v, list) else v for v, f in zip(row, fields)], schema=fields)
                    at += 1

    return runs


def placed(rows: DataFrame, thresholds: int) -> DataFrame:
    """Rows of thousands of ``judged`` predictions of a class in the order of confidence: ``scores``, ``right``, and before them in their class ``pos`` predictions, ``hits`` of them right."""
    order = [F.col("cls"), F.desc("score"), F.col("image"), F.col("ord")]
    sorted_ = rows.repartitionByRange(rows.count() // SORTED + 1, *order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("range"), "cls", "score", "right")
    out = rows.select(F.lit(0).alias("range"), F.lit(0).alias("run"), "cls", F.lit(0).cast("bigint").alias("n"), F.array("score").alias("scores"), F.array("right").alias("right"), F.array(F.lit(0).cast("bigint")).alias("hits")).schema
    runs = written(sorted_.mapInArrow(_runs(thresholds, to_arrow_schema(out)), out))
    before = Window.partitionBy("cls").orderBy("range", "run").rowsBetween(Window.unboundedPreceding, -1)  # a row for thousands
    sums = {"pos": F.col("n"), **{f"h{i}": F.col("hits")[i] for i in range(thresholds)}}
    starts = runs.select("range", "run", "cls", *(F.coalesce(F.sum(v).over(before), F.lit(0)).alias(k) for k, v in sums.items()))
    starts = starts.select("range", "run", "pos", F.array(*(f"h{i}" for i in range(thresholds))).alias("hits"))
    return runs.drop("hits").join(starts, ["range", "run"])


def _reached(x: Column, n: Column) -> Column:
    """The most hits whose recall, of n labels, is x or less, as doubles compare."""
    k = F.floor(x * n)
    return F.when((k + 1) / n <= x, k + 1).when(k / n <= x, k).otherwise(k - 1)


def _places(thresholds: int, fields: pa.Schema):
    """What the curves need of each run of ``placed``: a row a place of recall and threshold, and, of threshold -1, a row a place of confidence."""
    x, step = lambda i: i * (1.0 / (RECALLS - 1)), 1.0 / (CONFIDENCES - 1)

    def recalls(level: int, right: np.ndarray, pos: int, hits: int, n: int) -> list[tuple]:
        """Place i reaches k_i hits; the hits beyond it up to the next place's belong to i."""
        at = np.flatnonzero(right >> level & 1)
        k, at = hits + 1 + np.arange(len(at)), pos + 1 + at
        guess = np.ceil(k / n * (RECALLS - 1)).astype(np.int64)
        i = np.where(x(guess - 1) >= k / n, guess - 1, np.where(x(guess) >= k / n, guess, guess + 1)) - 1  # before the first place that reaches this hit
        start = np.flatnonzero(np.diff(i, prepend=-9))
        tops = np.maximum.reduceat(k / at, start) if len(start) else []
        return [(level, int(i[j]), float(top), int(at[j]), 0, int(m), 0.0, 0.0, 0) for j, top, m in zip(start, tops, np.diff(start, append=len(at)))]

    def confidences(scores: np.ndarray, right: np.ndarray, pos: int, hits: int) -> list[tuple]:
        guess = np.floor(np.clip(np.nan_to_num(scores, nan=2.0), -1.0, 2.0) * (CONFIDENCES - 1)).astype(np.int64)
        i = np.where((guess + 1) * step <= scores, guess + 1, np.where(guess * step <= scores, guess, guess - 1)).clip(-1, CONFIDENCES - 1)
        start = np.flatnonzero(np.diff(i, prepend=-9))
        k = hits + np.cumsum(right & 1)
        return [(-1, int(i[a]), 0.0, pos + int(a) + 1, pos + int(b), int(k[b - 1]), float(scores[b - 1]), float(scores[a]), int(right[a] & 1)) for a, b in zip(start, [*start[1:], len(i)])]

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for j in range(b.num_rows):
                scores, right = (b[c][j].values.to_numpy() for c in ("scores", "right"))
                pos, n, hits = b["pos"][j].as_py(), b["n_labels"][j].as_py(), b["hits"][j].as_py()
                found = confidences(scores, right, pos, hits[0])
                for level in range(thresholds):
                    found += recalls(level, right, pos, hits[level], n)
                cls = b["cls"].take(pa.array([j] * len(found)))
                yield pa.RecordBatch.from_arrays([cls, *(pa.array(v, f.type) for v, f in zip(zip(*found), list(fields)[1:]))], schema=fields)

    return places


def places(rows: DataFrame, counts: DataFrame, thresholds: int) -> DataFrame:
    """(cls, level, i, top, first, last, k, low, score, tp): ``placed`` rows, of the classes of ``counts`` (cls, n_labels), as what ``average_precision`` and ``curves`` need of them."""
    more = "level int, i int, top double, first bigint, last bigint, k bigint, low double, score double, tp bigint"
    near = rows.join(F.broadcast(counts.select("cls", "n_labels")), "cls")  # a row a class
    out = near.select("cls", *(F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in more.split(", "))).schema
    return near.select("cls", "n_labels", "pos", "hits", "scores", "right").mapInArrow(_places(thresholds, to_arrow_schema(out)), out)


def average_precision(found: DataFrame, counts: DataFrame, thresholds: int) -> DataFrame:
    """(cls, level, ap): the area under the envelope of precision over recall, by the trapezoids of 101 places.

    ``found`` are the ``places``, ``counts`` (cls, n_labels, n_preds) the classes.
    """
    hits = found.where("level >= 0")
    few = hits.groupBy("cls", "level", "i").agg(F.max("top").alias("top"), F.min("first").alias("pos"))
    total = hits.groupBy("cls", "level").agg(F.sum("k").alias("found"))
    grid = counts.select("*", F.explode(F.sequence(F.lit(0), F.lit(thresholds - 1))).alias("level")).join(total, ["cls", "level"], "left").fillna(0, ["found"])
    grid = grid.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(RECALLS - 1)))).join(few, ["cls", "level", "i"], "left")
    right = Window.partitionBy("cls", "level").orderBy(F.desc("i"))  # 101 rows a class and threshold
    grid = grid.withColumns({"top": F.coalesce(F.max("top").over(right), F.lit(0.0)), "next": F.last("pos", True).over(right), "x": F.col("i") * (1.0 / (RECALLS - 1))})
    k = F.least(F.greatest(_reached(F.col("x"), F.col("n_labels")), F.lit(0)), F.col("found"))
    last = F.col("next").isNull()  # no hit lies beyond this place: the curve falls to (1, 0)
    end = F.when(last, F.col("n_preds")).otherwise(F.col("next") - 1)  # the last row before the next hit
    low = F.greatest(F.when(end > 0, k / end).otherwise(0.0), F.col("top"))
    r0, r1, high = k / F.col("n_labels"), F.when(last, 1.0).otherwise((k + 1) / F.col("n_labels")), F.when(last, 0.0).otherwise(F.col("top"))
    at = F.when((F.col("i") == RECALLS - 1) | (F.col("n_preds") == 0), 0.0).when(r1 > r0, low + (F.col("x") - r0) / (r1 - r0) * (high - low)).otherwise(low)
    values = grid.select("cls", "level", "i", at.alias("v"))
    weight = F.when(F.col("i").isin(0, RECALLS - 1), 0.5).otherwise(1.0) / (RECALLS - 1)
    return values.groupBy("cls", "level").agg(F.sum(F.col("v") * weight).alias("ap"))


def curves(found: DataFrame, counts: DataFrame) -> DataFrame:
    """(cls, i, p, r): precision and recall at the first threshold for 1,000 confidences from 0 to 1, between the rows round each."""
    step = 1.0 / (CONFIDENCES - 1)
    few = found.where("level = -1").groupBy("cls", "i").agg(F.max("last").alias("pos"), F.max("k").alias("k"), F.min("low").alias("low"), F.min_by(F.struct("score", "tp"), "first").alias("head"))
    grid = counts.withColumn("i", F.explode(F.sequence(F.lit(-1), F.lit(CONFIDENCES - 1)))).join(few, ["cls", "i"], "left")
    above = Window.partitionBy("cls").orderBy(F.desc("i"))  # 1,001 rows a class
    below = Window.partitionBy("cls").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    grid = grid.withColumns({"pos": F.last("pos", True).over(above), "k": F.last("k", True).over(above), "low": F.last("low", True).over(above), "head": F.last("head", True).over(below)}).where("i >= 0")
    x, n = F.col("i") * step, F.col("n_labels")

    def between(left: Column, right: Column, before: float) -> Column:
        share = (F.col("low") - x) / (F.col("low") - F.col("head.score"))
        return F.when(F.col("n_preds") == 0, 0.0).when(F.col("pos").isNull(), before).when(F.col("head").isNull(), left).otherwise(left + share * (right - left))

    hits, rank = F.col("k") + F.col("head.tp"), F.col("pos") + 1
    return grid.select("cls", "i", between(F.col("k") / F.col("pos"), hits / rank, 1.0).alias("p"), between(F.col("k") / n, hits / n, 0.0).alias("r"))


def best_confidence(points: DataFrame) -> DataFrame:
    """(i): the place of greatest mean F1 over the classes, smoothed over 101 places; the first of equal ones."""
    f1 = points.groupBy("i").agg(F.avg(2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r") + 1e-16)).alias("f"))
    line = f1.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "f"))), lambda s: s["f"]).alias("f"))  # 1,000 numbers
    inside = lambda i: F.greatest(F.lit(0), F.least(F.lit(CONFIDENCES - 1), i))
    mean = lambda i: F.aggregate(F.sequence(i - SMOOTH, i + SMOOTH), F.lit(0.0), lambda a, j: a + F.get("f", inside(j))) / (2 * SMOOTH + 1)
    smooth = line.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(CONFIDENCES - 1)), lambda i: F.struct(F.round(mean(i), 12).alias("f"), i.alias("i")))).alias("s"))
    return smooth.agg(F.max_by("s.i", F.struct("s.f", -F.col("s.i"))).alias("i"))


def by_class(predictions: DataFrame, labels: DataFrame, thresholds: tuple[float, ...] = THRESHOLDS) -> DataFrame:
    """(cls, n_labels, n_preds, precision, recall, ap50, ap) of each labelled class.

    Precision and recall are those at the confidence that is best for all classes together; ``ap50`` is the average
    precision at the first threshold and ``ap`` its mean over all.  Predictions of classes without labels don't count.
    """
    n_labels = checkpointed(_known(labels).select("image", "cls", "ord").distinct().groupBy("cls").agg(F.count("*").alias("n_labels")))  # a row a class
    counted = predictions.join(F.broadcast(n_labels.select("cls")), "cls", "left_semi")
    # What is written is read more than once.
    rows = placed(written(judged(counted, labels, thresholds)), len(thresholds))
    found = checkpointed(places(rows, n_labels, len(thresholds)))
    n_preds = rows.groupBy("cls").agg(F.sum("n").alias("n_preds"))
    counts = checkpointed(n_labels.join(n_preds, "cls", "left").fillna(0, ["n_preds"]))
    areas = average_precision(found, counts, len(thresholds)).groupBy("cls").agg(F.max(F.when(F.col("level") == 0, F.col("ap"))).alias("ap50"), F.avg("ap").alias("ap"))
    points = checkpointed(curves(found, counts))
    at = points.join(F.broadcast(best_confidence(points)), "i").select("cls", F.col("p").alias("precision"), F.col("r").alias("recall"))  # one row
    return counts.join(at, "cls").join(areas, "cls").select("cls", "n_labels", "n_preds", "precision", "recall", "ap50", "ap")


def summary(classes: DataFrame, goal: float = GOAL) -> DataFrame:
    """(mp, mr, map50, map, verdict): means over the classes, and whether the goal for ``map50`` is reached; null without labels."""
    means = classes.agg(F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("ap50").alias("map50"), F.avg("ap").alias("map"))
    return means.withColumn("verdict", F.when(F.col("map50") >= goal, REACHED).when(F.col("map50").isNotNull(), MISSED))

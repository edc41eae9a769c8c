"""Copies of images, cropped or edited, by local descriptors.

Images are grey rasters (binary pixels, row by row, with width and height).  On each level of a pyramid that
shrinks by ``SHRINK`` down to the size of a patch, every pixel whose Harris response is the largest within
``APART`` pixels is a corner, however many there are.  Each gets an orientation from its intensity centroid and
``BITS`` binary tests between smoothed points of a pattern turned by it.

Descriptors meet in Hamming tables: each is entered under every one of its ``TABLES`` parts.  A pair of images
with ``LEAST_SEEDS`` corners of the first that share a bucket with one of the second within ``SEED_DISTANCE``
bits is a candidate.  Candidates are verified: their descriptors are matched mutually, and each match proposes the turn,
scale and shift that it implies; a pair is a copy if ``LEAST_INLIERS`` matches agree with one proposal, whichever
of the two images it starts from.  Components of copies are the groups.

A group of m near copies has m * m pairs, which are not needed for its component.  So each image first meets the
head (the least key) of each of its buckets, which is linear; then every two entries of a bucket are compared
unless their images are in one component already.  A bucket of over ``BLOCK`` entries is dealt into blocks, and
each pair of blocks is compared by itself, so that no task holds a whole bucket.  Byte-equal images are one entry
from the start.

Null or empty pixels, rasters whose size doesn't fit, flat rasters and those below 27 pixels have no corners: they
equal only byte-equal images, and null ones none.  Repeated rows are byte-equal images.  Null ids are kept and
head no group but their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import components, discard, saved

BITS = 128
#: Tables, half of them for each word of 64 bits, and the bits of each one's part: more and shorter ones find more and compare more.
TABLES, WIDTH = 8, 18
#: Each level's size relative to the one before.
SHRINK = 0.7
#: A corner's response is the largest within so many pixels.
APART = 3
#: Response that a corner has at least.
RESPONSE = 1.0
#: Entries of a bucket that are compared in one piece, about; larger buckets are dealt into pairs of blocks.
BLOCK = 4_096
#: Bits in which the descriptors of one corner may differ: where it makes a pair a candidate, and where a candidate is verified.
SEED_DISTANCE, DISTANCE = 16, 20
LEAST_SEEDS = 3
LEAST_INLIERS = 4
#: Pixels that a match may miss its proposal's place by.
MISS = 3.0
#: Radius of a patch, the rim without corners, and the rows beyond a strip that its corners depend on.
_RADIUS, _EDGE, _HALO = 12, 13, 18
#: Pixels worked on at once, and pairs of entries compared at once.
_PIXELS, _PAIRS = 1 << 18, 1 << 20


def _pattern() -> np.ndarray:
    """Fixed pattern of test points, drawn once from a normal law within the radius."""
    points = np.random.default_rng(20).normal(0, _RADIUS / 2, (40 * BITS, 2, 2))
    return points[(np.hypot(points[..., 0], points[..., 1]) <= _RADIUS - 1).all(axis=1)][:BITS]


_PATTERN = _pattern()
_DISC = np.stack(np.nonzero(np.hypot(*np.mgrid[-_RADIUS : _RADIUS + 1, -_RADIUS : _RADIUS + 1]) <= _RADIUS)) - _RADIUS


def _blur(a: np.ndarray, times: int = 1) -> np.ndarray:
    """1-2-1 over rows and columns; edges repeat."""
    for _ in range(times):
        p = np.concatenate([a[..., :1, :], a, a[..., -1:, :]], axis=-2)
        a = p[..., :-2, :] + p[..., 2:, :] + 2 * a
        p = np.concatenate([a[..., :1], a, a[..., -1:]], axis=-1)
        a = (p[..., :-2] + p[..., 2:] + 2 * a) * np.float32(1 / 16)
    return a


def _between(n: int, m: int, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each of ``m`` places on a line of ``n``: the places on both sides, and the share of the second."""
    at = np.clip((np.arange(m) + 0.5) / scale - 0.5, 0, n - 1)
    low = np.minimum(at.astype(np.int64), max(n - 2, 0))
    return low, np.minimum(low + 1, n - 1), (at - low).astype(np.float32)


def resized(images: np.ndarray, scale: float) -> np.ndarray:
    """8-bit images (n, h, w) smoothed and sampled anew, in strips of rows."""
    n, h, w = images.shape
    m, out_w = max(1, int(h * scale)), max(1, int(w * scale))
    low, high, share = _between(h, m, scale)
    left, right, across = _between(w, out_w, scale)
    out = np.empty((n, m, out_w), dtype=np.uint8)
    step = max(1, int(_PIXELS * scale / (n * w)))
    for i in range(0, m, step):
        a, b, f = low[i : i + step], high[i : i + step], share[i : i + step, None]
        first, end = max(0, int(a[0]) - 2), int(b[-1]) + 3
        soft = _blur(images[:, first:end].astype(np.float32))
        rows = soft[:, a - first] * (1 - f) + soft[:, b - first] * f
        out[:, i : i + step] = np.rint(rows[..., left] * (1 - across) + rows[..., right] * across)
    return out


def _highest(a: np.ndarray, axis: int) -> np.ndarray:
    """The maximum of every 2 * APART + 1 neighbours on an axis, by doubling."""
    size, have = 2 * APART + 1, 1
    cut = lambda x, s, e: x[..., s:e, :] if axis == -2 else x[..., s:e]
    while have < size:
        step = min(have, size - have)
        a = np.maximum(cut(a, 0, a.shape[axis] - step), cut(a, step, a.shape[axis]))
        have += step
    return a


def corners(images: np.ndarray) -> dict[str, np.ndarray]:
    """Corners of grey 8-bit images (n, h, w): image, x, y in its pixels, size, angle, and bits as two 64-bit numbers."""
    found: dict[str, list[np.ndarray]] = {k: [] for k in ("image", "x", "y", "size", "angle", "bits")}
    size = 1.0
    while min(images.shape[1:]) >= 2 * _EDGE + 1:
        n, h, w = images.shape
        step = max(1, _PIXELS // (n * w))
        for top in range(_EDGE, h - _EDGE, step):
            end = min(top + step, h - _EDGE)
            first, last = max(0, top - _HALO), min(h, end + _HALO)
            a = _blur(images[:, first:last].astype(np.float32))
            dy, dx = np.zeros_like(a), np.zeros_like(a)
            dy[:, 1:-1], dx[..., 1:-1] = (a[:, 2:] - a[:, :-2]) / 2, (a[..., 2:] - a[..., :-2]) / 2
            xx, yy, xy = (_blur(g, 2) for g in (dx * dx, dy * dy, dx * dy))
            r = xx * yy - xy * xy - np.float32(0.05) * (xx + yy) ** 2
            window = r[:, top - first - APART : end - first + APART, _EDGE - APART : w - _EDGE + APART]
            inner = window[:, APART:-APART, APART:-APART]
            k, y, x = np.nonzero((inner >= _highest(_highest(window, -2), -1)) & (inner > RESPONSE))
            y, x = y + top - first, x + _EDGE
            for i in range(0, len(k), 1 << 12):
                _described(a, *(v[i : i + (1 << 12)] for v in (k, y, x)), first, size, found)
        images, size = resized(images, SHRINK), size / SHRINK
    kinds = {"image": np.int64, "bits": np.int64}
    out = {c: np.concatenate([np.zeros((0, 2) if c == "bits" else 0, kinds.get(c, np.float32)), *v]) for c, v in found.items()}
    order = np.argsort(out["image"], kind="stable")
    return {c: v[order] for c, v in out.items()}


def _described(a: np.ndarray, k: np.ndarray, y: np.ndarray, x: np.ndarray, first: int, size: float, found: dict[str, list[np.ndarray]]) -> None:
    w = a.shape[2]
    at = ((k * a.shape[1] + y) * w + x)[:, None]
    patch = a.ravel()[at + (_DISC[0] * w + _DISC[1])]
    angle = np.arctan2((patch * _DISC[0].astype(np.float32)).sum(axis=1), (patch * _DISC[1].astype(np.float32)).sum(axis=1))
    c, s = np.cos(angle)[:, None], np.sin(angle)[:, None]
    soft = _blur(a).ravel()
    turned = lambda p: np.rint(p[:, 0] * s + p[:, 1] * c).astype(np.int64) * w + np.rint(p[:, 0] * c - p[:, 1] * s).astype(np.int64)
    tests = soft[at + turned(_PATTERN[:, 0])] < soft[at + turned(_PATTERN[:, 1])]
    found["image"].append(k)
    found["bits"].append(np.packbits(tests, axis=1, bitorder="little").view(np.int64))
    for name, v in (("x", (x + 0.5) * size - 0.5), ("y", (y + first + 0.5) * size - 0.5), ("size", np.full(len(x), size)), ("angle", angle)):
        found[name].append(v.astype(np.float32))


_LISTS = "x array<float>, y array<float>, size array<float>, angle array<float>, b0 array<bigint>, b1 array<bigint>"


def describe(images: DataFrame) -> DataFrame:
    """(key, x, y, size, angle, b0, b1 as arrays) of rasters (key, pixels, width, height), row by row; equal keys are equal rasters."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = b["key"].to_numpy()
            distinct, first, back = np.unique(key, return_index=True, return_inverse=True)
            shapes: dict[tuple[int, int], list[int]] = {}
            for i, (w, h, n) in enumerate(zip(*(b[c].take(pa.array(first)).to_pylist() for c in ("width", "height", "bytes")))):
                if w and h and w > 0 and h > 0 and n == w * h:
                    shapes.setdefault((h, w), []).append(i)
            parts: list[tuple[np.ndarray, dict[str, np.ndarray]]] = []
            for (h, w), rows in shapes.items():
                at_once = max(1, _PIXELS // (h * w))
                for i in range(0, len(rows), at_once):
                    some = rows[i : i + at_once]
                    stack = np.stack([np.frombuffer(b["pixels"][int(first[r])].as_buffer(), np.uint8).reshape(h, w) for r in some])
                    c = corners(stack)
                    parts.append((np.array(some)[c.pop("image")], c))
            of = np.concatenate([np.zeros(0, np.int64), *(p[0] for p in parts)])
            order = np.argsort(of, kind="stable")
            count = np.bincount(of, minlength=len(distinct))
            start = np.cumsum(count) - count
            # Each row's corners, those of equal rasters again.
            sizes = count[back]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            take = order[np.repeat(start[back] - ends[:-1], sizes) + np.arange(ends[-1])]
            ends = pa.array(ends.astype(np.int32))
            flat = {k: np.concatenate([np.zeros(0, np.float32), *(p[1][k] for p in parts)])[take] for k in ("x", "y", "size", "angle")}
            bits = np.concatenate([np.zeros((0, 2), np.int64), *(p[1]["bits"] for p in parts)])[take]
            flat |= {"b0": bits[:, 0], "b1": bits[:, 1]}
            yield pa.RecordBatch.from_arrays([b["key"], *(pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(v))) for v in flat.values())], ["key", *flat])

    rows = images.select("key", "pixels", "width", "height", F.octet_length("pixels").alias("bytes"))
    return rows.mapInArrow(find, f"key bigint, {_LISTS}")


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)).sum(axis=-1)


def _part(table: int) -> tuple[int, int]:
    """The word that a table's bits stand in and their place there; parts cover the word and share a few bits."""
    per_word = TABLES // 2
    return table // per_word, table % per_word * (64 - WIDTH) // max(1, per_word - 1)


def _entries(described: DataFrame, *more: str) -> DataFrame:
    """(t, part, key, i, b0, b1): each corner under its part of each table."""
    points = described.select("key", *more, F.posexplode(F.arrays_zip("b0", "b1")).alias("i", "d")).select("key", *more, "i", "d.b0", "d.b1")
    parts = [F.shiftrightunsigned(F.col(f"b{w}"), s).bitwiseAND(F.lit((1 << WIDTH) - 1)) for w, s in map(_part, range(TABLES))]
    return points.select("key", *more, "i", "b0", "b1", F.posexplode(F.array(*parts)).alias("t", "part"))


def met_heads(described: DataFrame) -> DataFrame:
    """(a, b): each image and the least key of buckets that it shares with it LEAST_SEEDS times or more; linear in the entries."""
    entries = _entries(described).select("t", "part", "key")
    # Saved, so that Spark may split the join where a bucket is hot.
    heads = saved(entries.groupBy("t", "part").agg(F.min("key").alias("a"), F.count("*").alias("n")).where("n > 1").select("t", "part", "a"))
    return entries.join(heads, ["t", "part"]).where("key <> a").groupBy("a", F.col("key").alias("b")).agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_SEEDS).select("a", "b")


def seeds(labelled: DataFrame) -> DataFrame:
    """(a, b): pairs of images of different labels with LEAST_SEEDS corners of ``a`` that share a bucket with one of ``b`` within SEED_DISTANCE bits."""
    entries = _entries(labelled, "label")
    sizes = entries.groupBy("t", "part").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    # Buckets of several labels; saved, so that Spark may split the join where one is hot.
    open_ = saved(sizes.select("t", "part", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    dealt = entries.join(open_, ["t", "part"]).withColumn("block", F.pmod(F.xxhash64("key", "i"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = dealt.select("t", "part", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "label", "key", "i", "b0", "b1")
    ordered = cells.repartition("t", "part", "p", "q").sortWithinPartitions("t", "part", "p", "q", "label")

    def compared(t: pa.Table) -> Iterator[pa.RecordBatch]:
        """Pairs of each cell; a pair that meets in several tables is told by the first."""
        cell = _runs(t, "t", "part", "p", "q")
        same = _runs(t, "t", "part", "p", "q", "label")
        key, i, table, block = (t[c].to_numpy() for c in ("key", "i", "t", "block"))
        apart = t["p"].to_numpy() != t["q"].to_numpy()
        bits = np.stack([t["b0"].to_numpy(), t["b1"].to_numpy()], axis=1)
        # An entry's partners stand from the end of its label's run to the end of its cell.
        start, end = np.searchsorted(same, same, side="right"), np.searchsorted(cell, cell, side="right")
        for x, y in _ranges(start, end):
            other = (~apart[x] | (block[x] != block[y])) & (key[x] != key[y])
            x, y = x[other], y[other]
            differ = (bits[x] ^ bits[y]).view(np.uint64)
            near = np.bitwise_count(differ).sum(axis=1) <= SEED_DISTANCE
            x, y, differ = x[near], y[near], differ[near]
            parts = np.stack([differ[:, w] >> np.uint64(s) & np.uint64((1 << WIDTH) - 1) for w, s in map(_part, range(TABLES))], axis=1)
            own = (parts == 0).argmax(axis=1) == table[x]
            x, y = x[own], y[own]
            if len(x):
                swap = key[x] > key[y]
                at = np.where(swap, i[y], i[x]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.where(swap, key[y], key[x])), pa.array(np.where(swap, key[x], key[y])), pa.array(at // 64), pa.array(np.int64(1) << at % 64)], ["a", "b", "word", "mask"])

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: list[pa.RecordBatch] = []
        for b in batches:
            if b.num_rows == 0:
                continue
            t = pa.Table.from_batches([*left, b]).combine_chunks()
            # The last cell may go on in the next batch.
            cell = _runs(t, "t", "part", "p", "q")
            cut = int(np.searchsorted(cell, cell[-1]))
            yield from compared(t.slice(0, cut))
            left = t.slice(cut).to_batches()
        if left:
            yield from compared(pa.Table.from_batches(left))

    # Corners of ``a`` as bits of 64-bit words: each counts once, however many of ``b`` it meets.
    met = ordered.mapInArrow(beside, "a bigint, b bigint, word bigint, mask bigint").groupBy("a", "b", "word").agg(F.bit_or("mask").alias("mask"))
    return met.groupBy("a", "b").agg(F.sum(F.bit_count("mask")).alias("n")).where(F.col("n") >= LEAST_SEEDS).select("a", "b")


def _runs(t: pa.Table, *columns: str) -> np.ndarray:
    """The number of each row's run of equal columns."""
    new = np.zeros(len(t), dtype=bool)
    for c in columns:
        v = t[c].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.cumsum(new)


def _ranges(start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(x, y) of every y in start[x] to end[x], about ``_PAIRS`` at once."""
    size = end - start
    total = np.cumsum(size)
    i = 0
    while i < len(size):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + _PAIRS, side="right")))
        n = size[i:j]
        x = np.repeat(np.arange(i, j), n)
        yield x, np.arange(len(x)) + np.repeat(start[i:j] - (np.cumsum(n) - n), n)
        i = j


def _matches(p: dict[str, np.ndarray], q: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Corners of both images that are each other's nearest within DISTANCE, by blocks of rows."""
    n, m = len(p["x"]), len(q["x"])
    to, least = np.zeros(n, np.int64), np.full(m, BITS + 1)
    back, near = np.zeros(m, np.int64), np.zeros(n, np.int64)
    step = max(1, (1 << 20) // max(1, m))
    for i in range(0, n, step):
        d = _distance(p["bits"][i : i + step, None], q["bits"][None])
        to[i : i + step], near[i : i + step] = d.argmin(axis=1), d.min(axis=1)
        low = d.min(axis=0)
        closer = low < least
        back[closer], least[closer] = d.argmin(axis=0)[closer] + i, low[closer]
    i = np.flatnonzero((near <= DISTANCE) & (back[to] == np.arange(n)))
    return i, to[i]


def inliers(p: dict[str, np.ndarray], q: dict[str, np.ndarray]) -> int:
    """Most mutual matches that agree with the similarity which one of them proposes, from either image to the other."""
    if len(p["x"]) == 0 or len(q["x"]) == 0:
        return 0
    i, j = _matches(p, q)
    if len(i) < LEAST_INLIERS:
        return 0
    return max(_agreeing(p, q, i, j), _agreeing(q, p, j, i))


def _agreeing(p: dict[str, np.ndarray], q: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> int:
    zp, zq = p["x"][i] + 1j * p["y"][i], q["x"][j] + 1j * q["y"][j]
    similarity = q["size"][j] / p["size"][i] * np.exp(1j * (q["angle"][j] - p["angle"][i]))
    most, best = 0, np.zeros(len(i), dtype=bool)
    for s in range(0, len(i), 512):
        of = similarity[s : s + 512, None]
        agree = np.abs(zq[None] - zq[s : s + 512, None] - of * (zp[None] - zp[s : s + 512, None])) <= MISS * np.maximum(1, np.abs(of))
        n = agree.sum(axis=1)
        if n.max() > most:
            most, best = int(n.max()), agree[n.argmax()]
    # Corners of several levels at one place count once.
    return min(len(np.unique(np.round(z[best] / 2))) for z in (zp, zq))


def verified(pairs: DataFrame, described: DataFrame) -> DataFrame:
    """(a, b): the pairs whose corners agree on one similarity."""
    side = lambda s: described.select(F.col("key").alias(s), F.struct("x", "y", "size", "angle", "b0", "b1").alias(f"_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    @F.arrow_udf("bigint")
    def count(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        def rows(c: pa.Array) -> list[dict[str, np.ndarray]]:
            lists = {k: c.field(k) for k in ("x", "y", "size", "angle", "b0", "b1")}
            cuts = np.array(lists["x"].offsets)
            flat = {k: np.array(v.values) for k, v in lists.items()}
            bits = np.stack([flat.pop("b0"), flat.pop("b1")], axis=1)
            return [{"bits": bits[s:e], **{k: v[s:e] for k, v in flat.items()}} for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

        for a, b in batches:
            yield pa.array([inliers(p, q) for p, q in zip(rows(a), rows(b))], pa.int64())

    return both.select("a", "b", count("_a", "_b").alias("n")).where(F.col("n") >= LEAST_INLIERS).select("a", "b")


def copies(images: DataFrame, id_col: str = "image_id") -> DataFrame:
    """(id, n_corners, n_copies, component_id) of every row of ``images`` (id, pixels, width, height).

    component_id is the smallest id of the row's group, n_copies the number of rows in it.
    """
    shape = images.select(F.col(id_col).alias("id"), "pixels", "width", "height")
    # One key for byte-equal rasters; a null raster is its own.
    key = F.when(F.col("pixels").isNotNull(), F.xxhash64("pixels", "width", "height")).otherwise(F.xxhash64(F.lit("none"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    keyed = shape.withColumn("key", key)
    marked = saved(keyed.select("id", "key", F.col("pixels").isNull().alias("none")))
    ids = marked.where(~F.col("none")).select("id", "key")
    # Pixels aren't shuffled: corners are.  Byte-equal rasters have equal corners, any of which serve.
    described = saved(describe(keyed).groupBy("key").agg(*(F.any_value(c.split()[0]).alias(c.split()[0]) for c in _LISTS.split(", "))))
    near = saved(verified(met_heads(described), described))
    roots = components(near).withColumnRenamed("node", "key")
    labelled = described.join(roots, "key", "left").withColumn("label", F.coalesce("root", "key"))
    links = saved(near.union(verified(seeds(labelled), described)))
    named = components(links).withColumnRenamed("node", "key")
    per_key = ids.groupBy("key").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    facts = saved(per_key.join(named, "key", "left").join(described.select("key", F.size("x").cast("bigint").alias("n_corners")), "key").select("key", "least", "n", "n_corners", F.coalesce("root", "key").alias("root")))
    discard(described, near, links)
    heads = facts.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("n_copies"))
    grouped = facts.join(heads, "root").select("key", "n_corners", "n_copies", "component_id")
    # Null rasters are groups of their own, whatever their ids.
    alone = marked.where("none").select("id", F.lit(0).cast("bigint").alias("n_corners"), F.lit(1).cast("bigint").alias("n_copies"), F.col("id").alias("component_id"))
    every = ids.join(grouped, "key").select("id", "n_corners", "n_copies", "component_id").union(alone)
    return every.withColumnRenamed("id", id_col)


def _textures(numbers: int, side: int) -> np.ndarray:
    """A fixed smooth random texture for each of a vector's numbers."""
    noise = np.stack([np.random.default_rng((64, k)).normal(size=(side, side)) for k in range(numbers)]).astype(np.float32)
    noise = _blur(noise, 4)
    noise -= noise.mean(axis=(1, 2), keepdims=True)
    return (noise / noise.std(axis=(1, 2), keepdims=True)).reshape(numbers, side * side)


def rendered(vectors: DataFrame, id_col: str, vector_col: str, side: int = 64) -> DataFrame:
    """(image_id, pixels, width, height): each vector drawn as a grey raster, the sum of one texture a number, of the vector's direction; null and empty vectors give null pixels, zero vectors flat ones."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        textures: dict[int, np.ndarray] = {}
        for b in batches:
            out: list[bytes | None] = [None] * b.num_rows
            sizes = np.array([0 if v is None else v for v in b["n"].to_pylist()])
            for n in np.unique(sizes[sizes > 0]).tolist():
                rows = np.flatnonzero(sizes == n)
                v = np.nan_to_num(np.array(b["v"].take(pa.array(rows)).flatten().fill_null(0.0), dtype=np.float32)).reshape(-1, n)
                v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
                if n not in textures:
                    textures[n] = _textures(n, side)
                for r, image in zip(rows.tolist(), np.clip(128 + 48 * (v @ textures[n]), 0, 255).round().astype(np.uint8)):
                    out[r] = image.tobytes()
            size = pa.array([side] * len(out), pa.int32())
            yield pa.RecordBatch.from_arrays([b["image_id"], pa.array(out, pa.binary()), size, size], ["image_id", "pixels", "width", "height"])

    kind = dict(vectors.dtypes)[id_col]
    return vectors.select(F.col(id_col).alias("image_id"), F.col(vector_col).alias("v"), F.size(vector_col).alias("n")).mapInArrow(draw, f"image_id {kind}, pixels binary, width int, height int")

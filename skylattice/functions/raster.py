"""Raster kernels on blue-green-red images, in numpy inside Arrow batches."""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .geo import TILE_PX, WINDOW_PX

#: Pixels of images worked on at once.
_AT_ONCE = 1 << 18


@dataclass(frozen=True)
class BlobLimits:
    """Colour bounds (hue 0-179, others 0-255, inclusive) and shape bounds of sought blobs; the defaults are fixed values."""

    low: tuple[int, int, int] = (35, 80, 60)
    high: tuple[int, int, int] = (85, 255, 255)
    area: tuple[float, float] = (300.0, 30_000.0)
    aspect: tuple[float, float] = (0.25, 4.0)


def to_hsv(bgr: np.ndarray) -> np.ndarray:
    """8-bit hue (halved degrees), saturation and value."""
    b, g, r = (bgr[..., i].astype(np.float64) for i in range(3))
    v, least = np.maximum(np.maximum(b, g), r), np.minimum(np.minimum(b, g), r)
    d = np.where(v == least, 1, v - least)
    h = np.where(v == r, (g - b) / d, np.where(v == g, 2 + (b - r) / d, 4 + (r - g) / d)) * 60
    h = np.where(v == least, 0, np.where(h < 0, h + 360, h))
    s = np.where(v == 0, 0, (v - least) / np.where(v == 0, 1, v) * 255)
    return np.stack([np.round(h / 2) % 180, np.round(s), v], axis=-1).astype(np.uint8)


def eroded(m: np.ndarray) -> np.ndarray:
    p = np.pad(m, [(0, 0), (1, 1), (1, 1)], constant_values=True)
    p = p[:, :-2] & p[:, 1:-1] & p[:, 2:]
    return p[..., :-2] & p[..., 1:-1] & p[..., 2:]


def dilated(m: np.ndarray) -> np.ndarray:
    return ~eroded(~m)


def coloured(bgr: np.ndarray, low: tuple[int, int, int], high: tuple[int, int, int]) -> np.ndarray:
    """Which pixels lie in the bounds of ``to_hsv``; hue is only worked out where value and saturation do."""
    b, g, r = (bgr[..., i] for i in range(3))
    v, least = np.maximum(np.maximum(b, g), r), np.minimum(np.minimum(b, g), r)
    top, bottom = np.arange(256.0)[:, None], np.arange(256.0)
    s = np.round(np.where(top == 0, 0, (top - bottom) / np.where(top == 0, 1, top) * 255))
    m = ((top >= low[2]) & (top <= high[2]) & (s >= low[1]) & (s <= high[1]))[v, least]
    hue = to_hsv(bgr[m])[..., 0]
    m[m] = (hue >= low[0]) & (hue <= high[0])
    return m


def _runs(m: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row (over all masks), start, end and component of the runs of set pixels of masks (n, h, w); reach 1 joins diagonal neighbours, 0 doesn't.

    A component's number is that of its first run.
    """
    n, h, w = m.shape
    edges = np.diff(np.pad(m, [(0, 0), (0, 0), (1, 1)]).astype(np.int8).reshape(n * h, w + 2), axis=1)
    row, start = np.nonzero(edges == 1)
    end = np.nonzero(edges == -1)[1]
    # Runs of the next row of the same mask that touch each run.
    span = w + 3
    first, last = row * span + start, row * span + end
    lo = np.searchsorted(last, (row + 1) * span + start + 1 - reach, side="left")
    hi = np.searchsorted(first, (row + 1) * span + end - 1 + reach, side="right")
    count = np.where(row % h == h - 1, 0, np.maximum(hi - lo, 0))
    a = np.repeat(np.arange(len(row)), count)
    b = np.arange(len(a)) + np.repeat(lo - (np.cumsum(count) - count), count)
    label = np.arange(len(row))
    while len(a):
        x, y = label[a], label[b]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label, label[label]):
            label = label[label]
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return row, start, end, label


def _painted(shape: tuple[int, ...], row: np.ndarray, start: np.ndarray, end: np.ndarray, value: np.ndarray) -> np.ndarray:
    size = end - start
    at = np.repeat(row * shape[2] + start - (np.cumsum(size) - size), size) + np.arange(size.sum())
    out = np.zeros(int(np.prod(shape)), dtype=value.dtype)
    out[at] = np.repeat(value, size)
    return out.reshape(shape)


def labelled(m: np.ndarray) -> np.ndarray:
    """8-connected components of masks (n, h, w): 0 outside, else a number of its own for each."""
    row, start, end, label = _runs(m, 1)
    return _painted(m.shape, row, start, end, label + 1)


def filled(m: np.ndarray) -> np.ndarray:
    """Masks (n, h, w) without holes: background that does not reach the edge is set."""
    h, w = m.shape[1:]
    row, start, end, label = _runs(~m, 0)
    outside = np.zeros(len(label), dtype=bool)
    outside[label[(row % h == 0) | (row % h == h - 1) | (start == 0) | (end == w)]] = True
    return ~_painted(m.shape, row, start, end, outside[label])


def blobs(bgr: np.ndarray, limits: BlobLimits = BlobLimits()) -> list[list[tuple[float, float, float]]]:
    """(px, py, area) of each image's components in the colour bounds after opening and closing, for images (n, h, w, 3).

    Only outer outlines count.  Area and centre are those of the outline through pixel centres (a full w x h block has
    (w - 1) * (h - 1)): of the squares between four set pixels and the triangles between three.
    """
    m = coloured(bgr, limits.low, limits.high)
    m = filled(eroded(dilated(dilated(eroded(m)))))
    n, h, w = m.shape
    row, start, end, of_run = _runs(m, 1)
    label = _painted(m.shape, row, start, end, of_run + 1)
    count = len(of_run) + 1
    corner = [label[:, dy : h - 1 + dy, dx : w - 1 + dx] for dy in (0, 1) for dx in (0, 1)]
    have = sum((c > 0).astype(np.int8) for c in corner)
    k, y, x = np.nonzero(have >= 3)
    of = np.maximum.reduce([c[k, y, x] for c in corner])
    full = have[k, y, x] == 4
    part = np.where(full, 1.0, 0.5)
    # A triangle's centre is the mean of its three corners.
    set_ = np.stack([c[k, y, x] > 0 for c in corner])
    cx = x + np.where(full, 0.5, (set_ * np.array([[0], [1], [0], [1]])).sum(axis=0) / 3)
    cy = y + np.where(full, 0.5, (set_ * np.array([[0], [0], [1], [1]])).sum(axis=0) / 3)
    area, mx, my = (np.bincount(of, weights=v, minlength=count) for v in (part, part * cx, part * cy))
    left, right, top, bottom = np.full(count, w), np.zeros(count, int), np.full(count, n * h), np.zeros(count, int)
    np.minimum.at(left, of_run + 1, start)
    np.maximum.at(right, of_run + 1, end)
    np.minimum.at(top, of_run + 1, row)
    np.maximum.at(bottom, of_run + 1, row + 1)
    out: list[list[tuple[float, float, float]]] = [[] for _ in range(n)]
    for i in np.unique(of_run + 1).tolist():
        aspect = (right[i] - left[i]) / (bottom[i] - top[i])
        if area[i] > 0 and limits.area[0] <= area[i] <= limits.area[1] and limits.aspect[0] <= aspect <= limits.aspect[1]:
            out[top[i] // h].append((float(mx[i] / area[i]), float(my[i] / area[i]), float(area[i])))
    return out


def compose_rgn(rgb: np.ndarray, irc: np.ndarray) -> np.ndarray:
    """A copy of ``rgb`` (blue-green-red) whose first channel is the near infrared, the third of ``irc``."""
    out = rgb.copy()
    out[..., 0] = irc[..., 2]
    return out


def median_hsv(bgr: np.ndarray, px: float, py: float, window: int = 9) -> tuple[float, ...] | None:
    """Median per channel of a patch round a point, clipped to the image; None if it is empty."""
    x, y, half = int(px), int(py), window // 2
    patch = bgr[max(0, y - half) : max(0, y + half + 1), max(0, x - half) : max(0, x + half + 1)]
    return tuple(float(c) for c in np.median(to_hsv(patch).reshape(-1, 3), axis=0)) if patch.size else None


def medians_hsv(stack: np.ndarray, px: list[float], py: list[float], window: int = 9) -> Iterator[tuple[int, tuple[float, ...]]]:
    """(place, median_hsv) of images (n, h, w, 3) with a patch, those with patches of one shape at once."""
    half = window // 2

    def span(p: list[float], size: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.array([min(max(int(v), -window), size + window) for v in p])
        low = np.clip(at - half, 0, size)
        return low, np.clip(at + half + 1, 0, size) - low

    (x, wide), (y, high) = span(px, stack.shape[2]), span(py, stack.shape[1])
    for h, w in np.unique(np.stack([high, wide], axis=1), axis=0).tolist():
        if h and w:
            of = np.nonzero((high == h) & (wide == w))[0]
            patch = stack[of[:, None, None], (y[of, None] + np.arange(h))[:, :, None], (x[of, None] + np.arange(w))[:, None, :]]
            for i, m in zip(of.tolist(), np.median(to_hsv(patch).reshape(len(of), h * w, 3), axis=1).tolist()):
                yield i, tuple(m)


def with_marker(bgr: np.ndarray, px: float, py: float, size: int = 20) -> np.ndarray:
    """A copy with a red cross at the rounded point."""
    out, x, y, half = bgr.copy(), round(px), round(py), size // 2
    h, w = bgr.shape[:2]
    if 0 <= y < h:
        out[y, max(0, x - half) : max(0, x + half + 1)] = (0, 0, 255)
    if 0 <= x < w:
        out[max(0, y - half) : max(0, y + half + 1), x] = (0, 0, 255)
    return out


def mosaic(tiles: list[tuple[int, int, np.ndarray]], ogx: float, ogy: float, px: int = WINDOW_PX) -> np.ndarray:
    """A window cut from tiles (x, y, bgr) at its rounded origin, which stays inside the tiles that the unrounded window touches; missing tiles are black."""
    inside = lambda o: max(math.floor(o / TILE_PX) * TILE_PX, min(round(o), (math.floor((o + px - 1) / TILE_PX) + 1) * TILE_PX - px))
    x0, y0 = inside(ogx), inside(ogy)
    out = np.zeros((px, px, 3), dtype=np.uint8)
    for x, y, t in tiles:
        left, top = x * TILE_PX - x0, y * TILE_PX - y0
        a, b = max(0, left), max(0, top)
        c, d = min(px, left + t.shape[1]), min(px, top + t.shape[0])
        if a < c and b < d:
            out[b:d, a:c] = t[b - top : d - top, a - left : c - left]
    return out


def _image(pixels: bytes | None, h: int, w: int) -> np.ndarray | None:
    return np.frombuffer(pixels, np.uint8).reshape(h, w, 3) if pixels is not None and len(pixels) == h * w * 3 else None


def _images(b: pa.RecordBatch, pixels: str = "pixels") -> Iterator[tuple[list[int], np.ndarray]]:
    """(rows, images (n, h, w, 3)) of a batch's readable images, by shape and about ``_AT_ONCE`` pixels at once."""
    shapes: dict[tuple[int, int], list[int]] = {}
    for i, (h, w, n) in enumerate(zip(b["height"].to_pylist(), b["width"].to_pylist(), pa.compute.binary_length(b[pixels]).to_pylist())):
        if h and w and h > 0 and w > 0 and n == h * w * 3:
            shapes.setdefault((h, w), []).append(i)
    for (h, w), rows in shapes.items():
        step = max(1, _AT_ONCE // (h * w))
        for i in range(0, len(rows), step):
            some = rows[i : i + step]
            yield some, np.stack([np.frombuffer(b[pixels][r].as_buffer(), np.uint8).reshape(h, w, 3) for r in some])


def _kind(df: DataFrame, column: str) -> str:
    return dict(df.dtypes)[column]


def detect_blobs(images: DataFrame, limits: BlobLimits = BlobLimits()) -> DataFrame:
    """(id, px, py, area, score) of images (id, height, width, pixels); unreadable images have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, stack in _images(b):
                found = [(r, *x) for r, xs in zip(rows, blobs(stack, limits)) for x in xs]
                of, px, py, area = (np.array([f[i] for f in found]) for i in range(4)) if found else (np.zeros(0, int), *(np.zeros(0) for _ in range(3)))
                yield pa.RecordBatch.from_arrays([b["id"].take(pa.array(of, pa.int64())), *(pa.array(v) for v in (px, py, area, np.ones(len(of))))], ["id", "px", "py", "area", "score"])

    return images.select("id", "height", "width", "pixels").mapInArrow(run, f"id {_kind(images, 'id')}, px double, py double, area double, score double")


def medians(images: DataFrame, window: int = 9) -> DataFrame:
    """(id, h, s, v): median_hsv round px, py of images (id, height, width, pixels, px, py); unreadable images and empty patches go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            px, py = b["px"].to_pylist(), b["py"].to_pylist()
            found = [(rows[i], *m) for rows, stack in _images(b) for i, m in medians_hsv(stack, [px[r] for r in rows], [py[r] for r in rows], window)]
            cols = list(zip(*found)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([b["id"].take(pa.array(cols[0], pa.int64())), *(pa.array(c, pa.float64()) for c in cols[1:])], ["id", "h", "s", "v"])

    return images.select("id", "height", "width", "pixels", "px", "py").mapInArrow(run, f"id {_kind(images, 'id')}, h double, s double, v double")


def marked(images: DataFrame, size: int = 20) -> DataFrame:
    """(id, height, width, pixels): images (id, height, width, pixels, px, py) with a cross at each one's point; an unreadable image fails the query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[bytes | None] = [None] * b.num_rows
            px, py = b["px"].to_pylist(), b["py"].to_pylist()
            for rows, stack in _images(b):
                for r, image in zip(rows, stack):
                    out[r] = with_marker(image, px[r], py[r], size).tobytes()
            if None in out:
                raise ValueError(f"image {b['id'][out.index(None)].as_py()!r} can't be read")
            yield pa.RecordBatch.from_arrays([b["id"], b["height"], b["width"], pa.array(out, pa.binary())], ["id", "height", "width", "pixels"])

    return images.select("id", "height", "width", "pixels", "px", "py").mapInArrow(run, f"id {_kind(images, 'id')}, height int, width int, pixels binary")


def composed(rgb: DataFrame, irc: DataFrame, on: str = "id") -> DataFrame:
    """(on, height, width, pixels): each window of ``rgb`` (on, height, width, pixels) with its near infrared from the same window of ``irc``; windows without a partner, or of another size, go."""
    both = rgb.select(on, "height", "width", "pixels").join(irc.select(on, F.col("height").alias("_h"), F.col("width").alias("_w"), F.col("pixels").alias("near")), on)
    both = both.where((F.col("height") == F.col("_h")) & (F.col("width") == F.col("_w"))).select(on, "height", "width", "pixels", "near")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = {r: image for rows, stack in _images(b, "near") for r, image in zip(rows, stack)}
            found = [(r, compose_rgn(image, near[r]).tobytes()) for rows, stack in _images(b) for r, image in zip(rows, stack) if r in near]
            at = pa.array([r for r, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*(b[c].take(at) for c in (on, "height", "width")), pa.array([p for _, p in found], pa.binary())], [on, "height", "width", "pixels"])

    return both.mapInArrow(run, f"{on} {_kind(rgb, on)}, height int, width int, pixels binary")


def assembled(window_tiles: DataFrame, tiles: DataFrame, px: int = WINDOW_PX) -> DataFrame:
    """(id, ogx, ogy, pixels): windows (id, ogx, ogy, x, y) put together from tiles (x, y, height, width, pixels); a window's tiles are few."""
    joined = window_tiles.join(tiles, ["x", "y"], "left")
    grouped = joined.groupBy("id", "ogx", "ogy").agg(F.collect_list(F.struct("x", "y", "height", "width", "pixels")).alias("tiles"))

    @F.arrow_udf("binary")
    def cut(tiles: pa.Array, ogx: pa.Array, ogy: pa.Array) -> pa.Array:
        cuts, flat = np.array(tiles.offsets).tolist(), tiles.values
        fields = {c: flat.field(c) for c in ("x", "y", "height", "width")}
        fields = {c: v.to_pylist() for c, v in fields.items()}
        pixels, out = flat.field("pixels"), []
        for s, e, gx, gy in zip(cuts, cuts[1:], ogx.to_pylist(), ogy.to_pylist()):
            read = [(fields["x"][i], fields["y"][i], _image(pixels[i].as_py(), fields["height"][i], fields["width"][i])) for i in range(s, e) if pixels[i].is_valid]
            out.append(mosaic([t for t in read if t[2] is not None], gx, gy, px).tobytes())
        return pa.array(out, pa.binary())

    return grouped.select("id", "ogx", "ogy", cut("tiles", "ogx", "ogy").alias("pixels"))


def predicted(windows: DataFrame, load: Callable[[], Callable[[list[np.ndarray]], list[list[tuple[float, float, float]]]]], conf: float, px: int = WINDOW_PX, at_once: int = 16) -> DataFrame:
    """(id, ogx, ogy, cx, cy, score, error) of windows (id, ogx, ogy, pixels) by a predictor.

    ``load`` runs once a partition and returns a function from a batch of images (``at_once`` at most) to lists of
    (cx, cy, score).  A batch that fails is tried window by window, and a window that fails gives one row with its
    error and no box; so does one that can't be read.
    """
    names = ("id", "ogx", "ogy", "cx", "cy", "score", "error")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = load()

        def told(images: list[np.ndarray]) -> list[list[tuple[float, float, float]] | str]:
            try:
                return predict(images)
            except Exception as e:  # noqa: BLE001 - one window's failure is a row
                return [repr(e)] if len(images) == 1 else [x for image in images for x in told([image])]

        for b in batches:
            for i in range(0, b.num_rows, at_once):
                some = list(zip(*(b.slice(i, at_once)[c].to_pylist() for c in ("id", "ogx", "ogy", "pixels"))))
                read = [_image(r[3], px, px) for r in some]
                found = iter(told([a for a in read if a is not None]) if any(a is not None for a in read) else [])
                rows = []
                for r, a in zip(some, read):
                    boxes = "unreadable window" if a is None else next(found)
                    rows += [(*r[:3], None, None, None, boxes)] if isinstance(boxes, str) else [(*r[:3], *map(float, x), None) for x in boxes if x[2] >= conf]
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=pa.schema([b.schema.field("id"), *((n, pa.float64()) for n in names[1:6]), ("error", pa.string())]))

    return windows.select("id", "ogx", "ogy", "pixels").mapInArrow(run, f"id {_kind(windows, 'id')}, ogx double, ogy double, cx double, cy double, score double, error string")


def compose_arrays(rgb: Column, irc: Column) -> Column:
    """The composition on arrays of blue, green, red per pixel."""
    return F.transform(rgb, lambda p, i: F.array(F.get(F.get(irc, i), F.lit(2)), F.get(p, F.lit(1)), F.get(p, F.lit(2))))


def encoded_png(bgr: np.ndarray) -> bytes:
    """An image (h, w, 3) as a PNG file: each line less the line above it, deflated."""
    h, w = bgr.shape[:2]
    rgb = bgr[..., ::-1].reshape(h, w * 3)
    lines = np.empty((h, 1 + w * 3), np.uint8)
    lines[:, 0] = 2
    lines[0, 1:] = rgb[0]
    np.subtract(rgb[1:], rgb[:-1], out=lines[1:, 1:])
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(lines.tobytes(), 6)) + part(b"IEND", b"")


def png(height: str, width: str, pixels: str) -> Column:
    """The PNG file of an image's columns; null for an unreadable one."""

    @F.arrow_udf("binary")
    def out(h: pa.Array, w: pa.Array, raw: pa.Array) -> pa.Array:
        images = (_image(p.as_py(), a, b) if a and b and a > 0 and b > 0 else None for a, b, p in zip(h.to_pylist(), w.to_pylist(), raw))
        return pa.array([None if i is None else encoded_png(i) for i in images], pa.binary())

    return out(height, width, pixels)


def resized(bgr: np.ndarray, side: int) -> np.ndarray:
    """A square of ``side`` pixels, each between the four nearest pixel centres."""

    def places(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.clip((np.arange(side) + 0.5) * (n / side) - 0.5, 0, n - 1)
        low = np.floor(at).astype(np.int64)
        return low, np.minimum(low + 1, n - 1), at - low

    (r0, r1, fr), (c0, c1, fc) = places(bgr.shape[0]), places(bgr.shape[1])
    lines = bgr.astype(np.float64)
    lines = lines[r0] * (1 - fr)[:, None, None] + lines[r1] * fr[:, None, None]
    return np.floor(lines[:, c0] * (1 - fc)[:, None] + lines[:, c1] * fc[:, None] + 0.5).astype(np.uint8)


def framed(bgr: np.ndarray, x0: int, y0: int, x1: int, y1: int) -> np.ndarray:
    """A copy with a red frame, two pixels wide, on a box's edges."""
    out, (h, w) = bgr.copy(), bgr.shape[:2]
    a, b, c, d = max(0, x0 - 1), max(0, y0 - 1), min(w, x1 + 1), min(h, y1 + 1)
    for top, bottom, left, right in ((b, y0 + 1, a, c), (max(0, y1 - 1), d, a, c), (b, d, a, x0 + 1), (b, d, max(0, x1 - 1), c)):
        out[top : max(top, bottom), left : max(left, right)] = (0, 0, 255)
    return out


def thumbnail(height: str, width: str, pixels: str, x0: str, y0: str, x1: str, y1: str, side: int) -> Column:
    """``side`` x ``side`` pixels of an image with its box framed; null for an unreadable image."""

    @F.arrow_udf("binary")
    def out(*columns: pa.Array) -> pa.Array:
        found = []
        for h, w, raw, *box in zip(*(c.to_pylist() for c in columns)):
            image = _image(raw, h, w) if h and w and h > 0 and w > 0 else None
            if image is not None and None not in box:
                image = framed(image, *map(int, box))
            found.append(None if image is None else resized(image, side).tobytes())
        return pa.array(found, pa.binary())

    return out(height, width, pixels, x0, y0, x1, y1)


def sheet(slots: Column, columns: int, side: int, empty: int = 50) -> Column:
    """struct<height, width, pixels>: thumbnails (r, c, pixels) in their slots, rows up to the last one used."""
    kind = pa.struct([("height", pa.int32()), ("width", pa.int32()), ("pixels", pa.binary())])

    @F.arrow_udf("struct<height:int,width:int,pixels:binary>")
    def out(column: pa.Array) -> pa.Array:
        found = []
        for some in column.to_pylist():
            board = np.full(((1 + max(s["r"] for s in some)) * side, columns * side, 3), empty, np.uint8)
            for s in some:
                if s["pixels"] is not None:
                    board[s["r"] * side : (s["r"] + 1) * side, s["c"] * side : (s["c"] + 1) * side] = np.frombuffer(s["pixels"], np.uint8).reshape(side, side, 3)
            found.append({"height": board.shape[0], "width": board.shape[1], "pixels": board.tobytes()})
        return pa.array(found, kind)

    return out(slots)


def band_sums(pixels: Column, bands: int = 3) -> Column:
    """struct<filled, sums>: pixels of an image that aren't 0 in all bands, and the sum of each band."""

    @F.arrow_udf("struct<filled:bigint,sums:array<bigint>>")
    def out(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            flat = [np.frombuffer(v.as_buffer(), np.uint8).reshape(-1, bands) if v.is_valid else np.zeros((0, bands), np.uint8) for v in column]
            yield pa.array([{"filled": int(f.any(axis=1).sum()), "sums": f.sum(axis=0, dtype=np.int64).tolist()} for f in flat], pa.struct([("filled", pa.int64()), ("sums", pa.list_(pa.int64()))]))

    return out(pixels)


def coloured_pixels(pixels: Column, bgr: tuple[int, int, int]) -> Column:
    """How many pixels of an image have a colour; null for none."""

    @F.arrow_udf("bigint")
    def out(column: pa.Array) -> pa.Array:
        colour = np.array(bgr, np.uint8)
        return pa.array([int((np.frombuffer(v.as_buffer(), np.uint8).reshape(-1, 3) == colour).all(axis=1).sum()) if v.is_valid else None for v in column], pa.int64())

    return out(pixels)

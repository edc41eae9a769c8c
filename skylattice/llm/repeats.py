"""Exact repeated passages by common-prefix interval trees over a distributed sparse suffix array.

A byte goes when a ``length``-byte string over it also starts earlier: in a document of smaller id, or further
left in the same one.

Sampling.  Every window of ``length`` bytes names one anchor, the position in it whose gram has the least hash
(leftmost on ties).  Equal windows name equal anchors at equal offsets, so it suffices to compare suffixes at
anchors: about one position in forty.  An anchor's context is the bytes that windows naming it can reach.

Dealing out.  Anchors whose gram occurs once go.  Occurrences with equal context are one entry with its first
occurrence, found by grouped minima; all later ones are covered whole.  What is left, gram by gram, are the
distinct contexts of repeated grams.

Interval tree.  The entries of a gram are its suffixes: they are sorted by what follows the anchor, and a stack
scan of the longest common prefixes yields the tree's intervals.  Within an interval the entries are ordered by
what precedes them, reading left, and scanned likewise: a set of entries is a maximal repeat if it shares
``right`` bytes rightwards, ``left`` bytes leftwards, and is extended in different ways on both sides.  Each
such set with left + right >= length is a group, with all of its entries as occurrences, neighbours in the
array or not.  All but the first occurrence of a group are covered.

A gram with over ``SPLIT`` distinct contexts is dealt out again, so that no task holds all of them.  A set that
shares ``left`` and ``right`` bytes, left + right >= length, shares ``k`` bytes rightwards and the ``length -
CUT - k`` bytes before them for the last cut k not beyond ``right``; so the entries are grouped anew, for each
such k, by these bytes, and each group has a tree of its own.  Groups of over ``ENTRIES`` even then have their
windows grouped by hash, which needs no list of them; either way gives the same spans.

Ids of any type stand in its order, null ids last (with the largest bigint).  Null text is empty.  Rows of equal id and
text are one document, each with the same result; of rows of equal id and different texts, null ids among them, none is
earlier than another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators._rows import numbered
from ._batch import PIECE_BYTES, PrefixHash, mix64, text_bytes
from ._store import discard, saved

GRAM = 16
#: Distinct contexts (at most 200 bytes each) of one gram beyond which it is dealt out again, and bytes between the cuts for that.
SPLIT, CUT = 2_000, 25
#: Contexts of one group that a task takes.
ENTRIES = 50_000
#: Entries that a task works on together, unless one gram has more.
SOLVED_AT_ONCE = 20_000
#: A place packs the text's number above the byte position; a string has under 2**31 bytes.
PLACE = 32
MASK = (1 << PLACE) - 1
_U = np.uint64
_PLACE_BITS = 22


#: The place of rows without an id.
_LAST = (1 << 63) - 1


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, d, t, text): all columns of each row in a struct, its document's place in the order of ids, and a number that tells texts of one id apart.

    Ids of whole numbers are their own places; others are numbered in their order.  Where an id has several texts (null
    ids count as one), these are numbered by their digests of 128 bits; elsewhere t is 0.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*(F.col(c) for c in docs.columns)).alias("row"), F.col(id_col).alias("id"), text.alias("text"))
    if dict(docs.dtypes)[id_col] in ("tinyint", "smallint", "int", "bigint"):
        rows = rows.withColumn("d", F.col("id").cast("bigint"))
    else:
        rows = rows.join(numbered(rows.where("id is not null").select("id").distinct(), "d", F.col("id")), "id", "left")
    rows = rows.withColumn("d", F.coalesce("d", F.lit(_LAST)))
    digest = rows.withColumn("m", F.md5(F.col("text").cast("binary")))
    several = saved(digest.groupBy("d").agg(F.min("m").alias("low"), F.max("m").alias("high")).where("low <> high").select("d"))
    if several.isEmpty():
        discard(several)
        return rows.select("row", "d", F.lit(0).cast("bigint").alias("t"), "text")
    marks = saved(numbered(digest.join(several, "d", "left_semi").select("d", "m").distinct(), "t", F.col("d"), F.col("m")).withColumn("t", F.col("t") + 1))
    discard(several)
    t = F.coalesce("t", F.lit(0))
    known = F.when(t <= MASK >> 1, t).otherwise(F.raise_error(F.lit("too many texts share their ids")).cast("bigint"))
    return digest.join(marks, ["d", "m"], "left").select("row", "d", known.alias("t"), "text")


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, position in the row, gram hash, context hash) of the anchors of all windows."""
    span = length - gram + 1
    rows, places, grams, contexts = [], [], [], []
    n, limit = len(offsets) - 1, (1 << _PLACE_BITS) - length
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PIECE_BYTES, side="right")) - 1)
        lo, end = int(offsets[i]), int(offsets[j])
        # One very long text is cut into slices that overlap by a context on both sides.
        for at in range(lo, max(end, lo + 1), limit - 4 * length) if end - lo > limit else [lo]:
            whole = end - lo <= limit
            a, b = (lo, end) if whole else (max(lo, at - 2 * length), min(end, at + limit - 2 * length))
            part = data[a:b]
            m = len(part)
            if m < length:
                continue
            bounds = np.concatenate([[0], offsets[i + 1 : j] - a, [m]]) if whole else np.array([0, m])
            hashed = PrefixHash(part)
            h = hashed.all(gram)
            with np.errstate(over="ignore"):
                key = h * _U(0xFF51AFD7ED558CCD)
            key &= ~_U((1 << _PLACE_BITS) - 1)
            key |= np.arange(len(key), dtype=np.uint64)
            pad = -len(key) % span
            blocks = np.concatenate([key, np.full(pad, ~_U(0))]).reshape(-1, span)
            ahead = np.minimum.accumulate(blocks, axis=1).ravel()
            back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
            windows = m - length + 1
            least = np.minimum(back[:windows], ahead[span - 1 : span - 1 + windows])
            inside = np.ones(windows + length, dtype=bool)
            for cut in bounds[1:-1].tolist():
                inside[max(0, cut - length + 1) : cut] = False
            place = (least[inside[:windows]] & _U((1 << _PLACE_BITS) - 1)).astype(np.int64)
            if len(place) == 0:
                continue
            place = place[np.concatenate([[True], place[1:] != place[:-1]])]
            row = np.searchsorted(bounds, place, side="right") - 1
            first, last = (bounds[row], bounds[row + 1])
            if not whole:  # anchors whose context the slice cuts belong to its neighbour
                own = ((a == lo) | (place >= length)) & ((b == end) | (place < m - length))
                place, row, first, last = place[own], row[own], first[own], last[own]
            left, right = np.minimum(place - first, span - 1), np.minimum(last - place, length)
            with np.errstate(over="ignore"):
                c = mix64(hashed(place - left, place + right) + left.astype(np.uint64) * _U(0x9E3779B97F4A7C15) + right.astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F))
            rows.append(row + i)
            places.append(place + a - (offsets[i + row] if whole else lo))
            grams.append(h[place])
            contexts.append(c)
        i = j
    if not rows:
        z = np.zeros(0, np.int64)
        return z, z, z.view(np.uint64), z.view(np.uint64)
    return tuple(np.concatenate(x) for x in (rows, places, grams, contexts))


def _anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, place, h, c = anchors(*text_bytes(b["text"]), length, gram)
            order = np.lexsort((place, c, row))
            own = np.zeros(len(row), dtype=bool)
            own[order[1:]] = (row[order[1:]] == row[order[:-1]]) & (c[order[1:]] == c[order[:-1]]) & (h[order[1:]] == h[order[:-1]])
            d, t = b["d"].to_numpy()[row], b["t"].to_numpy()[row]
            yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(t << PLACE | place), pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), pa.array(own)], ["d", "at", "h", "c", "own"])

    return docs.select("d", "t", "text").mapInArrow(scan, "d bigint, at bigint, h bigint, c bigint, own boolean")


def intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(depth, first, end) of each interval of two or more suffixes that share ``depth`` >= least bytes; lcp[i] is that of suffixes i and i + 1."""
    stack: list[tuple[int, int]] = []  # (depth, first)
    for i, depth in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > depth:
            top, first = stack.pop()
            if top >= least:
                yield top, first, i + 1
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def _matrix(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer(b"".join([x.ljust(width, b"\0") for x in texts]), dtype=np.uint8).reshape(len(texts), width), size


def _sorted_with_lcp(group: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The order of the texts within their groups, and the bytes that each shares with the one before; -1 for a group's first."""
    width = max(1, max(map(len, texts)))
    rows, size = _matrix(texts, width)
    keys = np.concatenate([group.astype(">u8").view(np.uint8).reshape(-1, 8), rows], axis=1)
    order = np.argsort(np.ascontiguousarray(keys).view(f"S{width + 8}").ravel(), kind="stable")
    lcp = np.full(len(texts), -1, dtype=np.int64)
    for i in range(0, len(texts) - 1, 1 << 14):
        a, b = order[i : i + (1 << 14)], order[i + 1 : i + 1 + (1 << 14)]
        a = a[: len(b)]
        differ = rows[a] != rows[b]
        n = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        lcp[i + 1 : i + 1 + len(b)] = np.where(group[a] == group[b], np.minimum(n, np.minimum(size[a], size[b])), -1)
    return order, lcp


def maximal_repeats(group: np.ndarray, left: list[bytes], right: list[bytes], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """(left bytes, right bytes, entries) of each maximal set of entries of one group that share them, left + right >= length.

    ``left`` reads away from the anchor; ``group`` ascends.  All groups are one array, whose intervals never cross them.
    """
    if len(group) < 2:
        return
    suffixes, lcp = _sorted_with_lcp(group, right)
    leftwards, common = _sorted_with_lcp(group, left)
    rank = np.empty(len(group), dtype=np.int64)
    rank[leftwards] = np.arange(len(group))
    place = np.empty(len(group), dtype=np.int64)
    place[suffixes] = np.arange(len(group))
    rank_of_suffix = rank[suffixes]
    few_ranks, few_common, few_left, few_lcp, few_place = rank_of_suffix.tolist(), common.tolist(), leftwards.tolist(), lcp.tolist(), place.tolist()
    most_left = max(map(len, left))
    for depth, first, end in intervals(few_lcp[1:], max(0, length - most_left)):
        if end - first <= 64:
            r = sorted(few_ranks[first:end])
            shared = [few_common[y] if y == x + 1 else min(few_common[x + 1 : y + 1]) for x, y in zip(r, r[1:])]
        else:
            r = np.sort(rank_of_suffix[first:end])
            shared = np.minimum.reduceat(common, (r + 1)[r + 1 < len(common)])[: len(r) - 1].tolist()
        if max(shared) + depth < length:
            continue
        for back, i, j in intervals(shared, length - depth):
            members = [few_left[x] for x in r[i:j]]
            at = [few_place[x] for x in members]
            # Extended alike to the right: a deeper interval has this set.
            if min(few_lcp[min(at) + 1 : max(at) + 1]) > depth:
                continue
            yield back, depth, members


def _spans_schema() -> str:
    return "d bigint, t bigint, s bigint, e bigint"


def _as_spans(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    x = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return pa.RecordBatch.from_arrays([pa.array(x[:, i]) for i in range(4)], ["d", "t", "s", "e"])


def _tree_spans(entries: DataFrame, length: int) -> DataFrame:
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []

        def solve(t: pa.Table) -> pa.RecordBatch:
            h = t["h"].to_numpy()
            group = np.cumsum(np.concatenate([[0], h[1:] != h[:-1]]))
            d, at = t["d"].to_numpy(), t["at"].to_numpy()
            d, at = d.tolist(), at.tolist()
            # All strings hold their anchor, so an entry's covered bytes are one run round it.
            back, ahead = [0] * len(d), [0] * len(d)
            for a, b, members in maximal_repeats(group, [x[::-1] for x in t["left"].to_pylist()], t["right"].to_pylist(), length):
                least = min(d[i] for i in members)
                own: dict[int, int] = {}
                for i in members:
                    if d[i] == least:
                        own[at[i] >> PLACE] = min(at[i], own.get(at[i] >> PLACE, at[i]))
                for i in members:
                    if d[i] > least or at[i] > own[at[i] >> PLACE]:
                        back[i], ahead[i] = max(back[i], a), max(ahead[i], b)
            rows = [(d[i], at[i] >> PLACE, (at[i] & MASK) - back[i], (at[i] & MASK) + ahead[i]) for i in range(len(d)) if ahead[i]]
            return _as_spans(rows)

        for b in batches:
            if b.num_rows == 0:
                continue
            parts.append(b)
            if sum(x.num_rows for x in parts) < SOLVED_AT_ONCE and b.num_rows:
                continue
            held = pa.Table.from_batches(parts)
            h = held["h"].to_numpy()
            change = np.flatnonzero(h[1:] != h[:-1])
            if len(change):
                yield solve(held.slice(0, int(change[-1]) + 1))
                parts = held.slice(int(change[-1]) + 1).combine_chunks().to_batches()
        if parts:
            yield solve(pa.Table.from_batches(parts))

    return entries.repartition("h").sortWithinPartitions("h").mapInArrow(walk, _spans_schema())


def _window_spans(entries: DataFrame, length: int) -> DataFrame:
    """The same for grams of any number of contexts: windows grouped by hash, minima before the shuffle."""
    o = F.col("o")
    windows = entries.select("d", "at", "left", "right", F.explode(F.sequence(F.lit(0), F.length("left"))).alias("o"))
    window = F.concat(F.substring(F.col("left"), F.length("left") - o + 1, o), F.substring(F.col("right"), F.lit(1), length - o))
    windows = windows.where(F.length("right") + o >= length).select("d", "at", "o", F.xxhash64(window).alias("w"), F.xxhash64(F.lit(1), window).alias("w2"))
    windows = windows.withColumn("t", F.shiftright("at", PLACE))
    least = windows.groupBy("w", "w2").agg(F.min("d").alias("least"))
    own = windows.groupBy("w", "w2", "d", "t").agg(F.min(F.col("at") - o).alias("own"))
    later = windows.join(least, ["w", "w2"]).join(own, ["w", "w2", "d", "t"]).where((F.col("d") > F.col("least")) | (F.col("at") - o > F.col("own")))
    start = F.col("at").bitwiseAND(F.lit(MASK)) - o
    return later.select("d", "t", start.alias("s"), (start + length).alias("e"))


def _dealt_again(contexts: DataFrame, length: int) -> DataFrame:
    """Entries with, as h, a hash of the gram and of the bytes round each cut that they have."""
    cuts = sorted({*range(0, max(1, length - CUT), CUT), max(0, length - CUT)})
    at = contexts.select("h", "d", "at", "left", "right", F.explode(F.array(*map(F.lit, cuts))).alias("k"))
    before = F.greatest(F.lit(0), length - CUT - F.col("k"))
    at = at.where((F.length("right") >= F.col("k")) & (F.length("left") >= before))
    own = F.xxhash64("h", "k", F.substring(F.col("right"), F.lit(1), F.col("k")), F.substring(F.col("left"), F.length("left") - before + 1, before))
    return at.select(own.alias("h"), "d", "at", "left", "right")


def _with_sizes(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The entries of groups of two or more with their group's size n, and the saved table of sizes; saved, so that Spark may split the join where a group is hot."""
    sizes = saved(entries.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"))
    return entries.join(sizes, "h"), sizes


def spans(docs: DataFrame, length: int = 100, gram: int = GRAM, entries: int = ENTRIES, split: int = SPLIT) -> DataFrame:
    """(d, t, s, e), saved: byte ranges of documents (d, t, text) that repeat earlier ones; ranges may overlap or reach beyond an end."""
    found = _anchor_rows(docs, length, gram)
    again = saved(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    repeated = saved(found.join(again, "h", "left_semi"))
    discard(again)
    # The first document of each context, in numbers that hash aggregation can update in place; ``own`` marks a context's returns within a document.
    first = saved(repeated.where(~F.col("own")).groupBy("h", "c").agg(F.min("d").alias("least")))
    several = saved(first.groupBy("h").agg(F.count("*").alias("contexts")).where("contexts > 1"))
    met = repeated.join(first, ["h", "c"])
    place = F.col("at").bitwiseAND(F.lit(MASK))
    whole = saved(met.where(F.col("own") | (F.col("d") > F.col("least"))).select("d", F.shiftright("at", PLACE).alias("t"), (place - (length - gram)).alias("s"), (place + length).alias("e")))
    wanted = met.where(~F.col("own") & (F.col("d") == F.col("least"))).select("h", "d", "at").join(several, "h")
    per_doc = wanted.groupBy("d", F.shiftright("at", PLACE).alias("t")).agg(F.collect_list(F.struct("h", "contexts", "at")).alias("w"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                lists = part["w"]
                items = lists.flatten()
                of = np.repeat(np.arange(len(part)), np.diff(np.array(lists.offsets)))
                at = items.field("at").to_numpy()
                texts = [x.as_py().encode() for x in part["text"]]
                pos = (at & MASK).tolist()
                left = [texts[r][max(0, p - (length - gram)) : p] for r, p in zip(of.tolist(), pos)]
                right = [texts[r][p : p + length] for r, p in zip(of.tolist(), pos)]
                yield pa.RecordBatch.from_arrays([items.field("h"), items.field("contexts"), pa.array(part["d"].to_numpy()[of]), items.field("at"), pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["h", "contexts", "d", "at", "left", "right"])

    texts = docs.join(per_doc, ["d", "t"])
    contexts = saved(texts.select("d", "t", "text", "w").mapInArrow(fetch, "h bigint, contexts bigint, d bigint, at bigint, left binary, right binary"))
    discard(repeated, first, several)
    few = contexts.where(F.col("contexts") <= split)
    dealt, sizes = _with_sizes(_dealt_again(contexts.where(F.col("contexts") > split), length))
    trees = saved(_tree_spans(few.select("h", "d", "at", "left", "right").unionByName(dealt.where(F.col("n") <= entries).drop("n")), length))
    large = saved(_window_spans(dealt.where(F.col("n") > entries), length))
    discard(contexts, sizes)
    return whole.unionByName(trees).unionByName(large)


def _merge(ranges: np.ndarray, size: int) -> np.ndarray:
    """Sorted maximal runs of ranges clipped to [0, size)."""
    if len(ranges) == 0:
        return np.zeros((0, 2), np.int64)
    r = np.clip(ranges[np.argsort(ranges[:, 0], kind="stable")], 0, size)
    end = np.maximum.accumulate(r[:, 1])
    new = np.concatenate([[True], r[1:, 0] > end[:-1]])
    first = np.flatnonzero(new)
    return np.stack([r[first, 0], end[np.append(first[1:], len(r)) - 1]], axis=1)


def _with_ranges(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """(row, ranges): all columns of each row in a struct, and the ranges to cut out of its text."""
    rows = _keyed(docs, id_col, text_col)
    found = spans(rows.select("d", "t", "text"), length)
    ranges = found.groupBy("d", "t").agg(F.collect_list(F.struct("s", "e")).alias("ranges"))
    return rows.select("row", "d", "t").join(ranges, ["d", "t"], "left").select("row", "ranges")


def _kept(text: pa.Array, ranges: pa.Array) -> Iterator[tuple[bytes, np.ndarray]]:
    for x, r in zip(text, ranges):
        raw = (x.as_py() or "").encode()
        lists = np.array([[q["s"], q["e"]] for q in r.as_py() or []], dtype=np.int64).reshape(-1, 2)
        yield raw, _merge(lists, len(raw))


def report(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, n_bytes, n_removed, n_spans, kept_sha256."""

    @F.arrow_udf("struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept_sha256:string>")
    def digest(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, ranges in batches:
            out = []
            for raw, runs in _kept(text, ranges):
                sha, at = hashlib.sha256(), 0
                for s, e in runs.tolist():
                    sha.update(raw[at:s])
                    at = e
                sha.update(raw[at:])
                out.append((len(raw), int((runs[:, 1] - runs[:, 0]).sum()), len(runs), sha.hexdigest()))
            cols = list(zip(*out)) or [[], [], [], []]
            yield pa.StructArray.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())], ["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = _with_ranges(docs.select(id_col, text_col), id_col, text_col, length)
    return joined.select(F.col("row")[id_col].alias(id_col), digest(F.col("row")[text_col], F.col("ranges")).alias("x")).select(id_col, "x.*")


def remove(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated bytes cut out of their texts; what is left of a cut character goes too."""

    @F.arrow_udf("string")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, ranges in batches:
            out = []
            for x, (raw, runs) in zip(text, _kept(text, ranges)):
                at, parts = 0, []
                for s, e in runs.tolist():
                    parts.append(raw[at:s])
                    at = e
                out.append(b"".join([*parts, raw[at:]]).decode("utf-8", errors="ignore") if x.is_valid else None)
            yield pa.array(out, pa.string())

    joined = _with_ranges(docs, id_col, text_col, length)
    return joined.select(*((cut(F.col("row")[c], F.col("ranges")) if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns))

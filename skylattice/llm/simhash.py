"""SimHash near-duplicates by a binary trie self-join.

A fingerprint bit is the majority of that bit over the XXH64 hashes of a text's word shingles.  Distinct
fingerprints within ``budget`` differing bits are found by traversing pairs of trie nodes together: a pair
carries the bits in which its prefixes differ, and is pruned when they exceed the budget.

Spark deals the trie out by bands.  Fingerprints with at most k differing bits agree in one of k + 1 bands
whole, so each band in turn is rotated to the top and every subtree below a band's value is one unit of
work.  A subtree with over ``SUBTREE`` fingerprints is split into parts, and each pair of parts is a unit.
A unit yields a spanning forest of its links, never all pairs; grouped minima join the forests.

Null and empty texts have fingerprint zero and link like any other.  Rows that repeat are documents of the
same fingerprint.  A null doc_id is kept, and is never a component's id unless all of its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._batch import LOWER, pieces, word_spans
from ._store import components, discard, saved

#: Fingerprints in one unit of work of the trie join.
SUBTREE = 100_000
#: Node pairs expanded at once inside a task.
FRONTIER = 1 << 17


def _piece_fingerprints(data: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh64_intdigest
    rows = len(offsets) - 1
    out = np.zeros(rows, dtype=np.uint64)
    row, start, end = word_spans(data, offsets)
    if len(row) == 0:
        return out
    # The words of all texts, each followed by one space.
    size = end - start + 1
    to = np.concatenate([[0], np.cumsum(size)])
    joined = np.append(LOWER[data], np.uint8(32))[np.arange(to[-1]) - np.repeat(to[:-1] - start, size)]
    joined[to[1:] - 1] = 32
    joined = joined.tobytes()
    per_row = np.bincount(row, minlength=rows)
    first = np.cumsum(per_row) - per_row
    i = np.arange(len(row))
    left = first[row] + per_row[row] - i  # words from here to the end of the text
    begins = (left >= width) | ((i == first[row]) & (per_row[row] < width))
    a = i[begins]
    b = np.minimum(a + width, first[row[a]] + per_row[row[a]]) - 1
    lo, hi = to[a].tolist(), (to[b + 1] - 1).tolist()
    hashes = np.fromiter((digest(joined[x:y], 42) for x, y in zip(lo, hi)), dtype=np.uint64, count=len(lo))
    of = row[a]
    cut = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    ends = np.append(cut[1:], len(of))
    for s, e in zip(cut.tolist(), ends.tolist()):
        ones = np.zeros(64, dtype=np.int64)
        for p in range(s, e, 1 << 16):
            ones += np.unpackbits(hashes[p : min(e, p + (1 << 16))].view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int32)
        out[of[s]] = np.packbits(2 * ones > e - s, bitorder="little").view(np.uint64)[0]
    return out


def fingerprint(text: Column, width: int = 4) -> Column:
    """The 64-bit SimHash of a text's ``width``-word shingles, as bigint."""

    @F.arrow_udf("bigint")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            parts = [_piece_fingerprints(data, offsets, width) for _, _, data, offsets in pieces(column)]
            yield pa.array(np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64), pa.int64())

    return of(text)


def _bands(budget: int) -> list[tuple[int, int]]:
    """(first bit from the top, bits) of each of budget + 1 bands."""
    at = [round(i * 64 / (budget + 1)) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(at, at[1:])]


class Forest:
    """Disjoint sets over array positions; each set's label is its smallest member."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while len(a):
            x, y = label[a], label[b]
            differ = x != y
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            if len(a) == 0:
                break
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label[:] = up


def trie_links(values: np.ndarray, units: np.ndarray, budget: int, depth: int) -> np.ndarray:
    """For each sorted value of each unit, the position of its set's first member, linking at ``budget`` differing bits or fewer.

    ``values`` ascend within a unit and agree on their first ``depth`` bits there.
    """
    n = len(values)
    forest = Forest(n)
    bounds = np.flatnonzero(np.concatenate([[True], units[1:] != units[:-1], [True]]))
    lo, hi = bounds[:-1], bounds[1:]
    big = hi - lo > 1
    ones: dict[int, np.ndarray] = {}
    stack = [(depth, lo[big], hi[big], lo[big], hi[big], np.zeros(int(big.sum()), np.int8))]
    while stack:
        d, alo, ahi, blo, bhi, err = stack.pop()
        if len(alo) > FRONTIER:
            for p in range(0, len(alo), FRONTIER):
                stack.append((d, *(x[p : p + FRONTIER] for x in (alo, ahi, blo, bhi, err))))
            continue
        if len(alo) == 0:
            continue
        # Small pairs of nodes, and all below the last bit, are compared value by value.
        small = ((ahi - alo) * (bhi - blo) <= 16) if d < 64 else np.ones(len(alo), bool)
        if small.any():
            _compare(values, alo[small], ahi[small], blo[small], bhi[small], budget, forest)
            alo, ahi, blo, bhi, err = (x[~small] for x in (alo, ahi, blo, bhi, err))
        if len(alo) == 0:
            continue
        if d not in ones:
            ones[d] = np.concatenate([[0], np.cumsum((values >> np.uint64(63 - d)) & np.uint64(1), dtype=np.int64)])
        c = ones[d]
        amid, bmid = ahi - (c[ahi] - c[alo]), bhi - (c[bhi] - c[blo])
        same = alo == blo
        other = ~same
        parts = [
            (alo, amid, blo, bmid, err),
            (amid, ahi, bmid, bhi, err),
            (alo, amid, bmid, bhi, err + 1),
            (amid[other], ahi[other], blo[other], bmid[other], err[other] + 1),
        ]
        nalo, nahi, nblo, nbhi, nerr = (np.concatenate(x) for x in zip(*parts))
        keep = (nahi > nalo) & (nbhi > nblo) & (nerr <= budget) & ~((nalo == nblo) & (nahi - nalo == 1))
        stack.append((d + 1, nalo[keep], nahi[keep], nblo[keep], nbhi[keep], nerr[keep]))
    return forest.label


def _compare(values, alo, ahi, blo, bhi, budget, forest) -> None:
    na, nb = ahi - alo, bhi - blo
    total = np.cumsum(na * nb)
    for p in _chunks(total, 1 << 21):
        size = (na * nb)[p]
        k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        width = np.repeat(nb[p], size)
        a, b = np.repeat(alo[p], size) + k // width, np.repeat(blo[p], size) + k % width
        near = (a != b) & (np.bitwise_count(values[a] ^ values[b]) <= budget)
        forest.join(a[near], b[near])


def _chunks(total: np.ndarray, limit: int) -> Iterator[slice]:
    i, n = 0, len(total)
    while i < n:
        done = total[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(total, done + limit, side="right")))
        yield slice(i, j)
        i = j


def links(fingerprints: DataFrame, budget: int = 4, subtree: int = SUBTREE) -> DataFrame:
    """(a, b): a spanning forest, per unit of the trie, of the distinct fingerprints (column fp) within ``budget`` bits."""
    bands = _bands(budget)
    fp = F.col("fp")
    rotated = [F.when(F.lit(at == 0), fp).otherwise(F.shiftleft(fp, at).bitwiseOR(F.shiftrightunsigned(fp, 64 - at))) for at, _ in bands]
    spread = fingerprints.select(F.explode(F.array(*(F.struct(F.lit(i).alias("band"), F.shiftrightunsigned(r, 64 - w).alias("top"), r.alias("v")) for i, (r, (_, w)) in enumerate(zip(rotated, bands))))).alias("s")).select("s.*")
    # The rare subtrees over the bound are dealt out as pairs of parts.
    large = spread.groupBy("band", "top").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    parts = F.ceil(F.col("n") / subtree).cast("int")
    sized = spread.join(large, ["band", "top"]).withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int"))
    with_ = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda q: F.struct(F.least("part", q).alias("i"), F.greatest("part", q).alias("j")))
    dealt = sized.select("band", "top", "v", F.explode(with_).alias("p")).select("band", "top", "p.i", "p.j", "v")
    dealt = dealt.repartition("band", "top", "i", "j").sortWithinPartitions("band", "top", "i", "j", F.col("v").bitwiseXOR(F.lit(-(1 << 63))))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solve(t: pa.Table) -> pa.RecordBatch:
            v = t["v"].to_numpy().view(np.uint64)
            keys = [t[c].to_numpy() for c in ("band", "top", "i", "j")]
            new = np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)])
            label = trie_links(v, np.cumsum(new), budget, min(w for _, w in bands))
            own = np.flatnonzero(label != np.arange(len(v)))
            at = np.array([a for a, _ in bands], dtype=np.uint64)[keys[0][own]]
            back = lambda x: np.where(at == 0, x, (x >> at) | (x << ((np.uint64(64) - at) & np.uint64(63)))).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(back(v[own])), pa.array(back(v[label[own]]))], ["a", "b"])

        def last_unit(t: pa.Table) -> int:
            """Where the last unit, which may go on in the next batch, begins."""
            n, keys = len(t), [t[c].to_numpy() for c in ("band", "top", "i", "j")]
            new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0))
            return int(new[-1]) + 1 if n > 1 and len(new) else 0

        for batch in batches:
            if batch.num_rows == 0:
                continue
            held.append(batch)
            t = pa.Table.from_batches(held)
            cut = last_unit(t)
            if cut:
                yield solve(t.slice(0, cut))
                held = t.slice(cut).combine_chunks().to_batches()
        if held:
            yield solve(pa.Table.from_batches(held))

    return dealt.mapInArrow(join, "a bigint, b bigint")


def _classes(prints: DataFrame, budget: int) -> DataFrame:
    """``prints`` (doc_id, fp, ...) with root, one fingerprint of the row's group, and component_id, its smallest id."""
    least = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(least.select("fp"), budget))
    grouped = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = saved(grouped.join(ids, "root").select("fp", "root", "component_id"))
    discard(least)
    return prints.join(named, "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, budget: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``; component_id is the smallest id reachable over links."""
    prints = saved(docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col), width).alias("fp")))
    return _classes(prints, budget).select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, budget: int = 4) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the smallest id, a null one only if the group has no other.

    Of rows with that id the one of least hash stays, and of rows with equal id and text any one.
    """
    own = [F.xxhash64(F.lit(salt), id_col, text_col) for salt in (1, 2)]
    prints = saved(docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col), width).alias("fp"), own[0].alias("k1"), own[1].alias("k2")))
    first = _classes(prints, budget).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keep = saved(first.groupBy("root").agg(F.min(F.struct("k1", "k2")).alias("k")).select("k.k1", "k.k2"))
    discard(prints)
    rows = docs.select(F.struct(*docs.columns).alias("row"), own[0].alias("k1"), own[1].alias("k2"))
    # The join deals rows out by both keys, so the second step needs no shuffle.
    return rows.join(keep, ["k1", "k2"]).dropDuplicates(["k1", "k2"]).select("row.*")

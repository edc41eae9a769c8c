"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Terms are lower-case words.  Every word of the labelled sample is a term, with the weight (1 + log tf) * idf * relevance.
Relevance is ``LEAST`` plus the standard deviations by which the term's examples of label 1 exceed what chance gives,
so that a few telling words aren't drowned by rare ones.  It is learnt from one half of the sample, chosen by hash of
the id.  Vectors are normalised, and examples with equal vectors are one entry with counts of both labels.

Entries stand in an inverted index in blocks of ``BLOCK``, and each term keeps its largest weight in every block that
it occurs in.  A query bounds each block by these weights of all of its terms, visits blocks by falling bound, some
at a time, and stops where none left can reach its k-th best cosine, so the neighbours are exact; postings of blocks
that it doesn't visit aren't read.  Each neighbour votes with its counts weighted by distance; the vote is mapped to
a probability by a logistic curve fitted on the other half of the sample, whose labels have no part in the relevance; their votes
leave the example itself out.

Evidence is the nearest entries: id of their first example, cosine, counts.  Texts without a term of the sample,
null and empty ones included, get the smoothed share of toxic examples among such examples and no evidence.
Without labelled rows every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._batch import LOWER, pieces, word_hashes
from ._labels import sample
from ._store import discard, saved

#: Labelled documents that examples come from, at most; the index holds their terms and no others.
SAMPLE_ROWS = 10_000
#: Relevance of a term that tells nothing.
LEAST = 0.05
#: Neighbours (distinct vectors) that vote.
NEIGHBOURS = 12
#: Entries of one block of the index.
BLOCK = 512
#: Share of the entries beyond which a term is frequent, and most frequent terms (4 bytes an entry each in a task).
FREQUENT, MOST_FREQUENT = 0.02, 1_024
#: Added to a distance before it divides a vote.
NEAR = 0.05
#: Bytes of texts whose terms are looked up at once.
PIECE = 1 << 19

#: A word ends at white space and ASCII marks.
_SEPARATOR = np.ones(256, dtype=bool)
_SEPARATOR[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_U = np.uint64


def counted_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, count) of each row's distinct terms, by row and hash."""
    row, _, _, h = word_hashes(LOWER[data], offsets, _SEPARATOR)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])])) if len(row) else row
    return row[new], h[new], np.diff(np.append(new, len(row)))


def _spread(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges, one range after the other, and the sizes."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum()), size


@dataclass
class Vocabulary:
    hashes: np.ndarray  # ascending
    weight: np.ndarray  # idf * relevance

    def vectors(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(row, terms ascending, weights) of each text with a term of the vocabulary."""
        for i, _, data, offsets in pieces(column, PIECE):
            row, h, count = counted_terms(data, offsets)
            if len(h) == 0 or len(self.hashes) == 0:
                continue
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            hit = self.hashes[at] == h
            of, term = row[hit], at[hit]
            weight = (1 + np.log(count[hit])) * self.weight[term]
            cut = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else of
            for s, e in zip(cut.tolist(), [*cut[1:].tolist(), len(of)]):
                w = weight[s:e]
                yield i + int(of[s]), term[s:e], w / np.sqrt(w @ w)


@dataclass
class Index:
    vocabulary: Vocabulary
    start: np.ndarray  # of each term's postings, and their end
    entry: np.ndarray  # of each posting; a term's ascend
    weight: np.ndarray  # of each posting
    counts: np.ndarray  # (entries, 2) of labels 0 and 1
    first: list  # id of each entry's first example
    blank: float  # score without terms
    slopes: tuple[float, float] = (1.0, 0.0)  # of the logistic curve
    _slot: np.ndarray = field(init=False, repr=False, default=None)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def __setstate__(self, state):
        self.__dict__ |= state | {"_slot": None}

    def _prepare(self) -> None:
        """Frequent terms' weights as one tile a block, and their largest in each block."""
        n, df = len(self.counts), np.diff(self.start)
        often = np.argsort(-df, kind="stable")[:MOST_FREQUENT]
        often = often[df[often] > FREQUENT * n]
        self._blocks = -(-n // BLOCK)
        self._slot = np.full(len(df), -1, dtype=np.int32)
        self._slot[often] = np.arange(len(often))
        self._tiles = np.zeros((self._blocks, len(often), BLOCK), dtype=np.float32)
        for i, t in enumerate(often.tolist()):
            p = slice(self.start[t], self.start[t + 1])
            self._tiles[self.entry[p] // BLOCK, i, self.entry[p] % BLOCK] = self.weight[p]
        self._tops = self._tiles.max(axis=2).T.copy()
        # Runs of postings of one term in one block.
        term, block = np.repeat(np.arange(len(df)), df), self.entry // BLOCK
        self._first = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])])) if len(term) else term
        self._size = np.diff(np.append(self._first, len(term)))
        self._block = block[self._first]
        self._top = np.maximum.reduceat(self.weight, self._first) if len(term) else self.weight
        self._runs = np.searchsorted(self._first, self.start)

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int = NEIGHBOURS) -> list[tuple[float, int]]:
        """The k entries of highest cosine above 0, ties by position: exact, by block bounds."""
        if self._slot is None:
            self._prepare()
        if self._blocks == 0:
            return []
        slot = self._slot[term]
        rare = slot < 0
        run, n = _spread(self._runs[term[rare]], self._runs[term[rare] + 1] - self._runs[term[rare]])
        of, block = np.repeat(weight[rare], n), self._block[run]
        slot, often = slot[~rare], weight[~rare].astype(np.float32)
        bounds = np.bincount(block, weights=of * self._top[run], minlength=self._blocks) + often @ self._tops[slot]
        order = np.argsort(-bounds, kind="stable")
        best_cosine, best = np.zeros(0), np.zeros(0, np.int64)
        least, i, many = 0.0, 0, 1
        while i < len(order):
            some = order[i : i + many]
            some = some[bounds[some] >= max(least - 1e-6, 1e-9)]
            if len(some) == 0:
                break
            place = np.full(self._blocks, -1)
            place[some] = np.arange(len(some))
            own = np.flatnonzero(place[block] >= 0)
            at, n = _spread(self._first[run[own]], self._size[run[own]])
            to = place[self.entry[at] // BLOCK] * BLOCK + self.entry[at] % BLOCK
            cosine = np.bincount(to, weights=np.repeat(of[own], n) * self.weight[at], minlength=len(some) * BLOCK)
            if len(slot):
                cosine = cosine + np.concatenate([often @ self._tiles[b].take(slot, axis=0) for b in some.tolist()])
            found = np.flatnonzero(cosine > max(least - 1e-6, 1e-9))
            best_cosine, best = np.concatenate([best_cosine, cosine[found]]), np.concatenate([best, some[found // BLOCK] * BLOCK + found % BLOCK])
            top = np.lexsort((best, -np.round(best_cosine, 6)))[:k]
            best_cosine, best = best_cosine[top], best[top]
            if len(best) == k:
                least = float(best_cosine[-1])
            i, many = i + many, many * 2
        return list(zip(best_cosine.tolist(), best.tolist()))

    def vote(self, found: list[tuple[float, int]], less: tuple[int, int] | None = None) -> float:
        """The weighted share of label 1, smoothed; less: an entry and label that don't count once."""
        yes, total = 0.05, 0.5
        for cosine, at in found:
            n, t = int(self.counts[at, 0] + self.counts[at, 1]), int(self.counts[at, 1])
            if less is not None and less[0] == at:
                n, t = n - 1, t - less[1]
            w = 1 / (1 - min(cosine, 1.0) + NEAR)
            yes, total = yes + w * t, total + w * n
        return yes / total

    def probability(self, vote: float) -> float:
        z = self.slopes[0] * np.log(max(vote, 1e-4) / max(1 - vote, 1e-4)) + self.slopes[1]
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _curve(votes: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from votes to labels, by Newton steps with a weak prior at (1, 0)."""
    x = np.log(np.clip(votes, 1e-4, 1) / np.clip(1 - votes, 1e-4, 1))
    x = np.stack([x, np.ones(len(x))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + 1.0 * (w - [1.0, 0.0])
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2), grad)
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Index | None:
    """An index of at most ``rows`` labelled documents of the training folds; None without any."""
    spark = docs.sparkSession

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per term: its examples, those of the half that relevance is learnt from, and those of them with label 1."""
        for b in batches:
            y_all, told_all = b["y"].to_numpy() > 0, ~np.array(b["other"].to_pylist(), dtype=bool)
            for i, j, data, offsets in pieces(b["text"], PIECE):
                row, h, _ = counted_terms(data, offsets)
                h, where, n = np.unique(h, return_inverse=True, return_counts=True)
                told = told_all[i:j][row]
                sums = [np.bincount(where, weights=v, minlength=len(h)).astype(np.int64) for v in (told, told & y_all[i:j][row])]
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n), *map(pa.array, sums)], ["h", "n", "told", "pos"])

    other = F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(2)) == 1
    picked = saved(sample(docs, labels, label, rows, id_col, text_col).withColumn("other", other).repartition(16))  # bounded: ``rows`` texts
    size: dict[tuple[bool, bool], int] = {}
    for r in picked.groupBy("other", "y").count().collect():
        size[r.other, r.y > 0] = size.get((r.other, r.y > 0), 0) + r["count"]
    total, toxic = sum(size.values()), sum(n for (_, y), n in size.items() if y)
    if total == 0:
        return None
    counted = picked.select("text", "y", "other").mapInArrow(distinct, "h bigint, n bigint, told bigint, pos bigint").groupBy("h").agg(*(F.sum(c).alias(c) for c in ("n", "told", "pos"))).toArrow()
    h, n, told, pos = counted["h"].to_numpy().view(np.uint64), *(counted[c].to_numpy() for c in ("n", "told", "pos"))
    order = np.argsort(h)
    h, n, told, pos = h[order], n[order], told[order], pos[order]
    yes = size.get((False, True), 0)
    chance = told * (yes / max(1, yes + size.get((False, False), 0)))
    relevance = LEAST + np.maximum(0, (pos - chance) / np.sqrt(chance + 1))
    vocabulary = Vocabulary(h, (np.log((total + 1) / (n + 0.5)) * relevance).astype(np.float32))
    words = spark.sparkContext.broadcast(vocabulary)

    def vectorise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = {r: (t, w) for r, t, w in words.value.vectors(b["text"])}
            none = (np.zeros(0, np.int32), np.zeros(0, np.float32))
            parts = [found.get(i, none) for i in range(b.num_rows)]
            ends = pa.array(np.concatenate([[0], np.cumsum([len(t) for t, _ in parts])]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([none[k], *(p[k] for p in parts)]).astype(kind))) for k, kind in ((0, np.int32), (1, np.float32))]
            yield pa.RecordBatch.from_arrays([b["id"], b["y"], b["other"], *lists], ["id", "y", "other", "t", "w"])

    vectors = saved(picked.select("id", "text", "y", "other").mapInArrow(vectorise, f"id {dict(picked.dtypes)['id']}, y int, other boolean, t array<int>, w array<float>"))
    index, entries = _index(vocabulary, vectors.toArrow(), toxic / total)
    shared = spark.sparkContext.broadcast(index)

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = b["y"].to_numpy()
            t, w, cuts = b["t"].flatten().to_numpy(), b["w"].flatten().to_numpy(), np.cumsum([0, *b["t"].value_lengths().to_pylist()]).tolist()
            own = [(shared.value.nearest(t[s:e].astype(np.int64), w[s:e].astype(np.float64)), v, t[s:e], w[s:e]) for s, e, v in zip(cuts, cuts[1:], y.tolist()) if e > s]
            out = [shared.value.vote(found, (entries[_key(ts, ws)], int(v > 0))) for found, v, ts, ws in own]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.float64()), pa.array([int(v > 0) for _, v, _, _ in own], pa.int64())], ["vote", "y"])

    told = vectors.where("other").select("y", "t", "w").mapInArrow(votes, "vote double, y bigint").toArrow()
    if told.num_rows:
        order = np.lexsort((told["y"].to_numpy(), told["vote"].to_numpy()))
        index.slopes = _curve(told["vote"].to_numpy()[order], told["y"].to_numpy()[order].astype(float))
    discard(picked, vectors)
    return index


def _key(term: np.ndarray, weight: np.ndarray) -> tuple[bytes, bytes]:
    return term.astype(np.int32).tobytes(), np.round(weight, 6).astype(np.float32).tobytes()


def _index(vocabulary: Vocabulary, examples: pa.Table, rate: float) -> tuple[Index, dict[tuple, int]]:
    """The index over examples (id, y, t, w), and the entry of each vector."""
    ids, y = examples["id"].to_pylist(), examples["y"].to_numpy()
    t, w = (examples[c].combine_chunks().flatten().to_numpy() for c in ("t", "w"))
    cuts = np.concatenate([[0], np.cumsum(examples["t"].combine_chunks().value_lengths().to_numpy())]).astype(np.int64)
    keys = [_key(t[s:e], w[s:e]) for s, e in zip(cuts, cuts[1:])]
    entries: dict[tuple, int] = {}
    first, counts, blank, owner = [], [], [0, 0], []
    # Entries by their terms, so that alike ones share blocks.
    for i in sorted(range(len(ids)), key=lambda i: (keys[i], ids[i])):
        if cuts[i] == cuts[i + 1]:
            blank[y[i] > 0] += 1
            continue
        if keys[i] not in entries:
            entries[keys[i]] = len(first)
            first.append(ids[i])
            counts.append([0, 0])
            owner.append(i)
        counts[entries[keys[i]]][int(y[i] > 0)] += 1
    of = np.concatenate([np.zeros(0, np.int64), *(np.arange(cuts[i], cuts[i + 1]) for i in owner)])
    entry = np.repeat(np.arange(len(owner)), [cuts[i + 1] - cuts[i] for i in owner]).astype(np.int32) if owner else np.zeros(0, np.int32)
    order = np.lexsort((entry, t[of]))
    start = np.searchsorted(t[of][order], np.arange(len(vocabulary.hashes) + 1))
    return Index(vocabulary, start, entry[order], w[of][order], np.array(counts, np.int64).reshape(-1, 2), first, (blank[1] + rate) / (sum(blank) + 1)), entries


def score(text: Column, index: Index | None) -> Column:
    """struct<score, evidence>: the probability of label 1, and the nearest entries as array<struct<example, cosine, clean, toxic>>."""
    from pyspark.sql import SparkSession

    shared = SparkSession.active().sparkContext.broadcast(index)

    @F.arrow_udf("struct<score:double,evidence:array<struct<example:string,cosine:double,clean:bigint,toxic:bigint>>>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = shared.value
        known: dict[tuple, tuple[float, list]] = {}
        kind = pa.list_(pa.struct([("example", pa.string()), ("cosine", pa.float64()), ("clean", pa.int64()), ("toxic", pa.int64())]))
        for column in batches:
            scores = np.full(len(column), 0.5 if index is None else index.blank)
            evidence: list[list] = [[] for _ in range(len(column))]
            for row, t, w in () if index is None else index.vocabulary.vectors(column):
                key = _key(t, w)
                if key not in known:
                    if len(known) > 5_000:
                        known.clear()
                    found = index.nearest(t, w)
                    known[key] = index.probability(index.vote(found)), [(str(index.first[at]), round(c, 6), *index.counts[at].tolist()) for c, at in found[:3]]
                scores[row], evidence[row] = known[key]
            rows = [[dict(zip(("example", "cosine", "clean", "toxic"), e)) for e in es] for es in evidence]
            yield pa.StructArray.from_arrays([pa.array(scores), pa.array(rows, kind)], ["score", "evidence"])

    return of(text)

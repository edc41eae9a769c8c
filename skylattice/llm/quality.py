"""Quality scores by a factorisation machine.

Inputs of a document: hashed words with their share of the text, one-hot bins of structure statistics, and its
length.  The score is the logistic of w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j, the pairs summed in
linear time as half of sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2).

Weights are learnt by AdaGrad in numpy from at most ``SAMPLE_ROWS`` labelled documents.  Null and empty texts
have no words and the statistics of an empty text.  Without labelled rows every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._batch import LOWER, pieces, word_hashes, word_spans
from ._labels import sample

#: Labelled documents that the weights are learnt from, at most.
SAMPLE_ROWS = 5_000
#: Buckets of hashed words.
WORDS = 1 << 14
#: Bins of one statistic.
BINS = 12
RANK = 6
EPOCHS = 60

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_WIDE = np.zeros(256, bool)
_WIDE[128:] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LINE = np.zeros(256, bool)
_LINE[10] = True

#: Structure statistics, in order.
STATISTICS = ("bytes", "words", "upper", "digits", "marks", "wide", "lines", "word_length", "distinct", "top_word", "marked_words", "repeated_lines", "capital_words", "letters")


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of runs of rows: (row, bucket, share) of each distinct word, and the statistics (rows, STATISTICS)."""
    for i, j, data, offsets in pieces(column):
        n = j - i
        size = np.diff(offsets)
        per = np.maximum(size, 1)
        sums = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[offsets])
        low = LOWER[data]
        row, start, end, h = word_hashes(low, offsets)
        words = np.bincount(row, minlength=n)
        each = np.maximum(words, 1)
        key = row * WORDS + (h & np.uint64(WORDS - 1)).astype(np.int64)
        pair, count = np.unique(key, return_counts=True)
        of = pair // WORDS
        top = np.zeros(n)
        np.maximum.at(top, of, count)
        lines = word_hashes(low, offsets, _LINE)
        line_keys = np.unique(np.stack([lines[0].astype(np.uint64), lines[3]]), axis=1)[0].astype(np.int64) if len(lines[0]) else np.zeros(0, np.int64)
        line_count = np.bincount(lines[0], minlength=n)
        last = low[end - 1] if len(end) else low[:0]
        marked = np.bincount(row, weights=~_LETTER[last] & ~_DIGIT[last] & (last != 46) & (last != 44), minlength=n)
        capital = np.bincount(row, weights=_UPPER[data[start]] if len(start) else None, minlength=n)
        s = np.stack(
            [
                np.log1p(size), np.log1p(words), sums(_UPPER[data]) / per, sums(_DIGIT[data]) / per, sums(~(_LETTER | _DIGIT | _SPACE)[data]) / per, sums(_WIDE[data]) / per,
                line_count / each, np.bincount(row, weights=end - start, minlength=n) / each, np.bincount(of, minlength=n) / each, top / each, marked / each,
                1 - np.bincount(line_keys, minlength=n) / np.maximum(line_count, 1), capital / each, sums(_LETTER[data]) / per,
            ],
            axis=1,
        )
        # Words weigh as one input in all, so that long and short texts are alike.
        yield of, pair % WORDS, np.sqrt(count / each[of]), s


@dataclass
class Machine:
    edges: np.ndarray  # (STATISTICS, BINS - 1), ascending
    bias: float
    weight: np.ndarray  # (WORDS + STATISTICS * BINS)
    factor: np.ndarray  # (the same, RANK)

    def inputs(self, of, bucket, share, stats):
        """All (row, input, value)."""
        n = len(stats)
        bins = np.stack([np.searchsorted(self.edges[k], stats[:, k], side="right") for k in range(len(STATISTICS))], axis=1)
        at = WORDS + np.arange(len(STATISTICS)) * BINS + bins
        return np.concatenate([of, np.repeat(np.arange(n), len(STATISTICS))]), np.concatenate([bucket, at.ravel()]), np.concatenate([share, np.full(at.size, 0.5)])

    def margin(self, row, i, x, n) -> tuple[np.ndarray, np.ndarray]:
        """The margins, and sum_i v_if x_i of each row."""
        linear = np.bincount(row, weights=self.weight[i] * x, minlength=n)
        vx = self.factor[i] * x[:, None]
        total = np.stack([np.bincount(row, weights=vx[:, f], minlength=n) for f in range(RANK)], axis=1)
        squares = np.bincount(row, weights=(vx * vx).sum(axis=1), minlength=n)
        return self.bias + linear + 0.5 * ((total**2).sum(axis=1) - squares), total

    def scores(self, column: pa.Array) -> np.ndarray:
        parts = [np.zeros(0)]
        for of, bucket, share, stats in features(column):
            z, _ = self.margin(*self.inputs(of, bucket, share, stats), len(stats))
            parts.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return np.concatenate(parts)


def train(of, bucket, share, stats, y, epochs: int = EPOCHS) -> Machine:
    """AdaGrad on the logistic loss over all rows given, with weight decay."""
    n, size = len(y), WORDS + len(STATISTICS) * BINS
    edges = np.quantile(stats, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    m = Machine(edges, 0.0, np.zeros(size), np.random.default_rng(0).normal(0, 0.05, (size, RANK)))
    row, i, x = m.inputs(of, bucket, share, stats)
    seen_b, seen_w, seen_v = 1e-6, np.full(size, 1e-6), np.full((size, RANK), 1e-6)
    decay, rate = 2e-3, 0.08
    m.bias = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    for _ in range(epochs):
        z, total = m.margin(row, i, x, n)
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        gx = g[row] * x
        gw = np.bincount(i, weights=gx, minlength=size) + decay * m.weight / size
        gv = np.stack([np.bincount(i, weights=gx * (total[row, f] - m.factor[i, f] * x), minlength=size) for f in range(RANK)], axis=1) + decay * m.factor / size
        gb = g.sum()
        seen_b, seen_w, seen_v = seen_b + gb**2, seen_w + gw**2, seen_v + gv**2
        m.bias -= rate * gb / np.sqrt(seen_b)
        m.weight -= rate * gw / np.sqrt(seen_w)
        m.factor -= rate * gv / np.sqrt(seen_v)
    return m


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Machine | None:
    """A machine from at most ``rows`` labelled documents of the training folds; None without any.  The driver gets their features, not their texts."""

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = 0
            for of, bucket, share, stats in features(b["text"]):
                n = len(stats)
                ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (bucket.astype(np.int32), share.astype(np.float32))]
                st = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(STATISTICS)), pa.array(stats.ravel()))
                yield pa.RecordBatch.from_arrays([b["id"].slice(done, n), b["y"].slice(done, n), *lists, st], ["id", "y", "bucket", "share", "stats"])
                done += n

    picked = sample(docs, labels, label, rows, id_col, text_col).select(F.col("id").cast("string").alias("id"), "text", "y")
    t = picked.mapInArrow(featurise, "id string, y int, bucket array<int>, share array<float>, stats array<double>").toArrow().sort_by("id").combine_chunks()
    if len(t) == 0:
        return None
    col = lambda c: t[c].combine_chunks()
    sizes = np.diff(np.array(col("bucket").offsets))
    return train(np.repeat(np.arange(len(t)), sizes), np.array(col("bucket").flatten()).astype(np.int64), np.array(col("share").flatten()).astype(np.float64), np.array(col("stats").flatten()).reshape(len(t), -1), t["y"].to_numpy().astype(np.float64))


def score(text: Column, machine: Machine | None) -> Column:
    """The probability of label 1."""

    @F.arrow_udf("double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array(np.full(len(column), 0.5) if machine is None else machine.scores(column), pa.float64())

    return of(text)

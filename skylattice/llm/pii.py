"""Personal data: exact base patterns, and a skip-chain conditional random field that adds spans.

Base spans are leftmost non-overlapping matches per kind (email, ip, card, phone) that pass the kind's test.
The field's nodes are the words of a document that hold a digit or an at-sign.  Neighbouring nodes share a
chain potential; a node and the previous one with the same (or, digits only, the same digits in another
layout) key share a skip potential however far apart they are.  Loopy sum-product message passing gives each
node's marginal over the kinds and "none", so that a number recognised once is recognised wherever it repeats.

Weights are learnt from nodes of a bounded sample of documents, labelled by the base spans: unary weights over
the shapes of a word and of its neighbours by multinomial logistic regression, pair potentials by smoothed
agreement counts.  Base spans always stay; added ones never overlap them or each other.

Null text is empty and has no spans.  Offsets are code points, end exclusive.  Repeated rows are rows; with no
sample to learn from, nothing is added.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds of personal data, in the order in which spans are listed; state 0 is none.
KINDS = ("email", "ip", "card", "phone")
STATES = len(KINDS) + 1

#: Buckets of hashed shape features.
FEATURES = 1 << 13
#: Documents (with a digit or an at-sign) and words that the weights are learnt from, at most.
SAMPLE_DOCUMENTS = 2_000
SAMPLE_WORDS = 40_000
#: Rounds of message passing; it ends sooner when messages settle.
ROUNDS = 12
#: Marginal probability from which a word gets a kind.
LEAST = 0.5

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NODE = re.compile(r"[^\s|]*[0-9@][^\s|]*")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted; kind counts from 0 in KINDS."""
    found = []
    at, free = text.find("@"), 0
    while at >= 0:  # a match holds an at-sign, its local part begins as far left as it can
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            found.append((start, 0, m.end()))
            free = m.end()
        else:
            free = max(free, at)
        at = text.find("@", max(at + 1, free))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def digest(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_SHAPE = str.maketrans({**{c: "9" for c in "0123456789"}, **{c: "a" for c in "abcdefghijklmnopqrstuvwxyz"}, **{c: "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}})


def _shape(word: str) -> str:
    return re.sub(r"a{2,}", "a+", re.sub(r"A{2,}", "A+", word[:40].strip(",;:!?\"'").rstrip(".").translate(_SHAPE)))


def _bucket(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode("utf-8", "replace"), digest_size=4).digest(), "little") % FEATURES


class _Buckets(dict):
    def __missing__(self, name: str) -> int:
        if len(self) > 200_000:
            self.clear()
        self[name] = b = _bucket(name)
        return b


_bucket_of = _Buckets()


@dataclass
class Nodes:
    """Nodes of a run of documents: document, start, end, features (n, 5), next[i] true if node i + 1 stands beside i, skip: pairs of nodes with one key."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    features: np.ndarray
    next: np.ndarray
    skip: np.ndarray


def nodes(texts: list[str]) -> Nodes:
    doc, start, end, features, beside, skip = [], [], [], [], [], []
    for d, text in enumerate(texts):
        last: dict[str, int] = {}
        first = len(doc)
        for m in _NODE.finditer(text):
            word, i = m[0], len(doc)
            doc.append(d)
            s, e = m.span()
            start.append(s)
            end.append(e)
            beside.append(i > first and 0 < s - end[i - 1] <= 2)
            digits = "".join(c for c in word if "0" <= c <= "9")
            key = "#" + digits if len(digits) >= 7 else word.strip(".,;:!?()").casefold()
            if key in last:
                skip.append((last[key], i))
            last[key] = i
            shape = _shape(word)
            features.append((_bucket_of["w" + shape], _bucket_of[f"d{min(len(digits), 24)}@{word.count('@')}.{min(word.count('.'), 4)}"]))
    n = len(doc)
    beside = np.array(beside[1:] + [False], dtype=bool) if n else np.zeros(0, bool)
    own = np.array(features, dtype=np.int64).reshape(n, 2)
    edge = np.array([_bucket_of["<none>"]])
    before = np.concatenate([edge, np.where(beside[:-1], own[:-1, 0], edge)]) if n else np.zeros(0, np.int64)
    after = np.concatenate([np.where(beside[:-1], own[1:, 0], edge), edge]) if n else np.zeros(0, np.int64)
    around = np.stack([own[:, 0], own[:, 1], (before * 7 + 1) % FEATURES, (after * 13 + 2) % FEATURES, (before * 31 + own[:, 0] * 17 + after) % FEATURES], axis=1) if n else np.zeros((0, 5), np.int64)
    return Nodes(np.array(doc, np.int64), np.array(start, np.int64), np.array(end, np.int64), around, beside, np.array(skip, np.int64).reshape(-1, 2))


def _labels(n: Nodes, spans: list[list[tuple[int, int, int]]]) -> np.ndarray:
    """The base kind (from 1) that covers each node's middle, else 0."""
    out = np.zeros(len(n.doc), dtype=np.int64)
    for i, (d, s, e) in enumerate(zip(n.doc.tolist(), n.start.tolist(), n.end.tolist())):
        for a, k, b in spans[d]:
            if a < e and s < b and 2 * (min(b, e) - max(a, s)) >= e - s:
                out[i] = k + 1
                break
    return out


@dataclass
class Field:
    unary: np.ndarray  # (FEATURES, STATES) log weights
    chain: np.ndarray  # (STATES, STATES) log potential of neighbours
    skip: np.ndarray  # of nodes with one key

    def marginals(self, n: Nodes) -> np.ndarray:
        """(nodes, STATES) by loopy sum-product message passing; sums of logs are normalised each round."""
        phi = self.unary[n.features].sum(axis=1)
        beside = np.flatnonzero(n.next)
        a = np.concatenate([beside, n.skip[:, 0]])
        b = np.concatenate([beside + 1, n.skip[:, 1]])
        kind = np.concatenate([np.zeros(len(beside), np.int64), np.ones(len(n.skip), np.int64)])
        potential = np.exp(np.stack([self.chain, self.skip]))[kind]  # [edge, state of a, state of b]
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        towards = np.concatenate([potential, potential.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
        message = np.zeros((len(source), STATES))
        order = np.argsort(target, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(target[order]) > 0])) if len(order) else order

        def belief() -> np.ndarray:
            total = phi.copy()
            if len(order):
                total[target[order][first]] += np.add.reduceat(message[order], first, axis=0)
            return total

        for _ in range(ROUNDS if len(source) else 0):
            out = belief()[source] - message[back]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            new = np.log(np.einsum("es,est->et", out, towards) + 1e-30)
            new -= np.log(np.exp(new).sum(axis=1, keepdims=True))
            new = 0.3 * message + 0.7 * new  # damped
            settled = np.abs(new - message).max() < 1e-3
            message = new
            if settled:
                break
        p = belief()
        p = np.exp(p - p.max(axis=1, keepdims=True)) if len(p) else p
        return p / p.sum(axis=1, keepdims=True) if len(p) else p

    def added(self, texts: list[str], base: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
        """For each text the spans that the field adds to the base ones."""
        n = nodes(texts)
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        p = self.marginals(n)
        best = p.argmax(axis=1) if len(p) else np.zeros(0, np.int64)
        chosen = np.flatnonzero((best > 0) & (p.max(axis=1, initial=0) >= LEAST))
        runs: list[list[int]] = []
        for i in chosen.tolist():  # neighbours of one kind are one span
            if runs and runs[-1][1] == i - 1 and n.next[i - 1] and best[i] == runs[-1][2]:
                runs[-1][1] = i
            else:
                runs.append([i, i, int(best[i])])
        for i, j, k in runs:
            d, s, e = int(n.doc[i]), int(n.start[i]), int(n.end[j])
            text = texts[d]
            while s < e and not (text[s].isalnum() or text[s] in "+("):
                s += 1
            while s < e and not text[e - 1].isalnum():
                e -= 1
            if s < e and all(b <= s or e <= a for a, _, b in base[d]):
                out[d].append((s, k - 1, e))
        return out


NOTHING = Field(np.concatenate([np.ones((FEATURES, 1)), np.zeros((FEATURES, STATES - 1))], axis=1), np.zeros((STATES, STATES)), np.zeros((STATES, STATES)))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """Weights from a bounded sample: the SAMPLE_WORDS first words of the SAMPLE_DOCUMENTS distinct texts of least hash; the driver gets these small rows, no texts."""

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            n = nodes(texts)
            h = batch["h"].to_numpy()[n.doc]
            y = _labels(n, [base_spans(t) for t in texts])
            skip = np.full(len(y), -1)
            skip[n.skip[:, 1]] = y[n.skip[:, 0]]
            beside = np.concatenate([[-1], np.where(n.next[:-1], y[:-1], -1)]) if len(y) else y
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * 5), pa.array(n.features.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n.start), lists, pa.array(y), pa.array(beside), pa.array(skip)], ["h", "at", "f", "y", "beside", "skip"])

    # Hashes alone are ordered; the texts up to the last one chosen are then read where they lie.
    marked = docs.select(F.col(text_col).alias("text"), F.xxhash64(F.lit(7), F.col(text_col)).alias("h")).where(F.col("text").rlike("[0-9@]"))
    last = marked.select("h").distinct().orderBy("h").limit(SAMPLE_DOCUMENTS).agg(F.max("h")).first()[0]
    picked = marked.where(F.col("h") <= last).dropDuplicates(["h"]) if last is not None else marked.limit(0)
    t = picked.select("text", "h").mapInArrow(featurise, "h bigint, at bigint, f array<bigint>, y bigint, beside bigint, skip bigint").orderBy("h", "at").limit(SAMPLE_WORDS).toArrow()
    if len(t) == 0:
        return NOTHING
    x = np.array(t["f"].combine_chunks().flatten()).reshape(-1, 5)
    y, beside, skip = (t[c].to_numpy() for c in ("y", "beside", "skip"))
    # Multinomial logistic regression by AdaGrad over the whole sample.
    w, seen = np.zeros((FEATURES, STATES)), np.full((FEATURES, STATES), 1e-8)
    truth = np.eye(STATES)[y]
    for _ in range(150):
        z = w[x].sum(axis=1)
        p = np.exp(z - z.max(axis=1, keepdims=True))
        g = p / p.sum(axis=1, keepdims=True) - truth
        grad = np.stack([np.bincount(x.ravel(), weights=np.repeat(g[:, k], 5), minlength=FEATURES) for k in range(STATES)], axis=1) + 1e-2 * w
        seen += grad**2
        w -= 0.4 * grad / np.sqrt(seen)

    def agreement(other: np.ndarray) -> np.ndarray:
        """Log of how much likelier pairs are than their parts, kept within a factor of e ** 3."""
        have = other >= 0
        joint = np.full((STATES, STATES), 0.5) + np.bincount(other[have] * STATES + y[have], minlength=STATES * STATES).reshape(STATES, STATES)
        joint /= joint.sum()
        return np.clip(np.log(joint / np.outer(joint.sum(axis=1), joint.sum(axis=0))), -3, 3)

    # Neighbours' shapes are unary features too, so the chain counts by half.
    return Field(w, 0.5 * agreement(beside), agreement(skip))


def spans(text: Column, field: Field) -> Column:
    """struct<base, all>: arrays of struct<start, kind, end>, sorted; kind counts from 0 in KINDS."""
    kind = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])

    @F.arrow_udf("struct<base:array<struct<start:int,kind:int,end:int>>,all:array<struct<start:int,kind:int,end:int>>>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def as_list(rows: list[list[tuple[int, int, int]]]) -> pa.Array:
            flat = np.array([x for r in rows for x in r], dtype=np.int32).reshape(-1, 3)
            ends = np.cumsum([0] + [len(r) for r in rows]).astype(np.int32)
            parts = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(kind))
            return pa.ListArray.from_arrays(pa.array(ends), parts)

        for column in batches:
            base, both = [], []
            for i in range(0, len(column), 500):
                texts = [x or "" for x in column.slice(i, 500).to_pylist()]
                own = [base_spans(t) for t in texts]
                base += own
                both += [sorted(a + b) for a, b in zip(own, field.added(texts, own))]
            yield pa.StructArray.from_arrays([as_list(base), as_list(both)], ["base", "all"])

    return find(text)


def _listed(found: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])))


def _only(k: int):
    return lambda x: F.when(x == k, x)


def report(docs: DataFrame, field: Field | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, base counts per kind, base_sha256 and all spans as text."""
    field = field or fit(docs, id_col, text_col)
    found = docs.select(F.col(id_col), spans(F.col(text_col), field).alias("s"))
    kinds = F.transform("s.base", lambda x: x["kind"])
    counts = [F.size(F.array_compact(F.transform(kinds, _only(k)))).cast("bigint").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select(id_col, *counts, F.sha2(_listed(F.col("s.base")), 256).alias("base_sha256"), _listed(F.col("s.all")).alias("spans"))


def redact(docs: DataFrame, field: Field | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with each span of personal data replaced by its kind in angle brackets; overlapping spans are replaced as one."""
    field = field or fit(docs, id_col, text_col)

    @F.arrow_udf("string")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            out = []
            for i in range(0, len(column), 500):
                texts = column.slice(i, 500).to_pylist()
                plain = [x or "" for x in texts]
                own = [base_spans(t) for t in plain]
                for raw, t, a, b in zip(texts, plain, own, field.added(plain, own)):
                    parts, at = [], 0
                    for s, k, e in sorted(a + b):
                        if s >= at:
                            parts += [t[at:s], f"<{KINDS[k].upper()}>"]
                        at = max(at, e)
                    out.append(raw if raw is None else "".join(parts) + t[at:])
            yield pa.array(out, pa.string())

    return docs.withColumn(text_col, clean(F.col(text_col))).select(*docs.columns)

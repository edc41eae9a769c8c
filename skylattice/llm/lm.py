"""Language-model scores: a causal self-attention model over subword ids, and a word-count base.

Texts are lower-cased (A-Z), cut into words at white space, and encoded word by word with a leading space by a
public byte-level vocabulary; an end id closes each text.  The model's probability of the next id is

    P(class | context) * P(id | class, previous id)

The second factor comes from id pairs counted over the whole training part of the corpus.  The first is a
softmax over the corpus' log P(class | previous id) plus a learnt term of one masked self-attention layer over
the last ``WINDOW`` ids.  The layer is trained in numpy on every window of every training text, equal windows being
one with a count that weighs its gradient.  Windows are dealt by hash to ``ROUNDS`` rounds and to parts of these, and
a part is cut into shares of about ``DEAL`` windows in the order of their hashes; each share takes Adam steps of
``BATCH`` windows of its own from the round's parameters, and Spark averages the shares by their windows.  So rounds
don't grow with the corpus, shares do, and the result doesn't depend on how rows are dealt out.  Texts are encoded
once, and their ids stand beside them in the shared folder.  Long texts are scored in overlapping windows,
each id once, with at least ``WINDOW - STRIDE`` ids of context wherever the text has them.

The base is a smoothed word unigram over all training tokens.  A word's ids multiply to the model's probability of
the word.  The score mixes it with the word's share c / N of the training tokens: log10((1 - MIX) * model + MIX * c / N).
Both parts sum to one or less over all words, so the score is the log of a probability; ``model_score`` is the sum
without the mix.  Words are told apart by 64-bit hashes.  The ``COMMON`` most frequent words'
counts, less the ties of the last, are broadcast (16 bytes each); all other occurrences meet their counts in a join, so that each is exact.

Null text is empty and holds only its end.  Repeated rows are rows (and training texts) of their own.  A null
doc_id belongs to the remainder of the empty text.  With nothing to learn from, all ids are equally likely.
"""

from __future__ import annotations

import base64
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._batch import LOWER, mix64, pieces, word_hashes
from ._labels import remainder
from ._store import discard, saved

#: Ids with a bucket of their own; all others share the last one, told apart by their own counts.
IDS = 1_024
CLASSES = 64
WIDTH = 16
WINDOW = 32
STRIDE = 24
#: Rounds of training, windows of a share about, and windows of one step.
ROUNDS, DEAL, BATCH = 8, 4_096, 64
#: Windows that are scored together, few enough for a core's cache.
TOGETHER = 128
#: Weight of the words' shares in the score.
MIX = 0.5
#: Words whose counts are broadcast.
COMMON = 1_000_000
#: Windows of a part about, and parts of a round at most.
GATHER, PARTS = 8_192, 4_000
#: Ids counted in a task before it hands on their sums.
FLUSH = 1 << 22
#: Words of the vocabulary's file and the end of a text.
VOCABULARY, END = 50_257, 50_256
_U = np.uint64


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


_encoders: dict[str, object] = {}


def encoder(path: str):
    """One encoder for each file and Python process."""
    if path not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding("ids", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


_heads: dict[str, np.ndarray] = {}


def heads(path: str) -> np.ndarray:
    """Whether an id begins a word (with its space) or ends a text."""
    if path not in _heads:
        table = np.zeros(VOCABULARY, dtype=bool)
        table[[i for i in range(END) if encoder(path).decode_single_token_bytes(i)[:1] == b" "]] = True
        table[END] = True
        _heads[path] = table
    return _heads[path]


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of all runs, one run after another."""
    after = np.cumsum(size)
    return np.repeat(start - after + size, size) + np.arange(size.sum())


class _Words:
    """Ids of the words that a process has met, found by their hashes; place 0 is a text's end."""

    BITS = 21

    def __init__(self):
        self.hashes, self.start, self.ids, self.again = np.zeros(1, np.uint64), np.array([0, 1]), np.array([END], np.uint16), np.zeros(1, bool)
        self._deal()

    def _deal(self) -> None:
        self.slot = np.zeros(1 << self.BITS, np.int32)
        self.slot[self._at(self.hashes[1:])] = np.arange(1, len(self.hashes))

    def _at(self, h: np.ndarray) -> np.ndarray:
        return (h & _U((1 << self.BITS) - 1)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The place of each word, 0 if it has none."""
        place = self.slot.take(self._at(h))
        place *= self.hashes.take(place) == h
        self.again[place] = True
        return place

    def add(self, h: np.ndarray, words: list[bytes], path: str) -> None:
        """Words that differ and have no place; exactly one id of each begins with its space."""
        ids = encoder(path).encode_to_numpy((b" " + b" ".join(words)).decode("utf-8", "replace"))
        begin = np.flatnonzero(heads(path)[ids])
        if len(begin) != len(words):  # white space beyond ASCII has joined a word's space
            parts = [_word_ids(w, path) for w in words]
            ids, begin = np.concatenate(parts), np.cumsum([0, *map(len, parts[:-1])])
        self.slot[self._at(h)] = np.arange(len(self.hashes), len(self.hashes) + len(h))
        self.start = np.concatenate([self.start[:-1], begin + len(self.ids), [len(self.ids) + len(ids)]])
        self.ids = np.concatenate([self.ids, ids.astype(np.uint16)])
        self.hashes = np.concatenate([self.hashes, h])
        self.again = np.concatenate([self.again, np.zeros(len(h), bool)])

    def thin(self, most: int) -> None:
        """Forgets words that weren't met again; all, if those that were are more than half of ``most``."""
        keep = np.flatnonzero(self.again)
        keep = np.append(0, keep[keep > 0] if len(keep) <= most // 2 else keep[:0])
        size = np.diff(self.start)[keep]
        self.ids = self.ids[_runs(self.start[keep], size)]
        self.start, self.hashes, self.again = np.append(0, np.cumsum(size)), self.hashes[keep], np.zeros(len(keep), bool)
        self._deal()


#: Words that a process keeps before it forgets those that it met once.
MET = 1 << 19
_words: dict[str, _Words] = defaultdict(_Words)


def encode(texts: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in a row, each closed by END, and the offset of each."""
    return _encode(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]), path)


def _encode(data: np.ndarray, offsets: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """As ``encode``; a word is encoded once as long as the process keeps it."""
    met, data = _words[path], LOWER[data]
    if len(met.hashes) > MET:
        met.thin(MET)
    row, start, end, h = word_hashes(data, offsets)
    place = met.find(h)
    new = np.flatnonzero(place == 0)
    if len(new):
        own, first, back = np.unique(h[new], return_index=True, return_inverse=True)
        low = data.tobytes()
        place[new] = len(met.hashes) + back
        met.add(own, [low[s:e] for s, e in zip(start[new[first]].tolist(), end[new[first]].tolist())], path)
    # A text's words stand before its end, which has place 0.
    ends = np.cumsum(np.bincount(row, minlength=len(offsets) - 1) + 1)
    code = np.zeros(len(row) + len(ends), np.int64)
    code[np.arange(len(row)) + row] = place
    begin = met.start.take(code)
    size = met.start.take(code + 1) - begin
    at = np.append(0, np.cumsum(size))
    return met.ids.take(_runs(begin, size)).astype(np.int64), at[np.append(0, ends)]


def _word_ids(word: bytes, path: str) -> np.ndarray:
    e = encoder(path)
    text = word.decode("utf-8", "replace")
    ids = e.encode_to_numpy(" " + text)
    return ids if np.count_nonzero(heads(path)[ids]) == 1 else np.concatenate([e.encode_to_numpy(" "), e.encode_to_numpy(text)])


def previous(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The id before each one; END before a text's first."""
    out = np.empty_like(ids)
    out[1:] = ids[:-1]
    out[offsets[:-1]] = END
    return out


def _packed(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of consecutive runs of rows."""
    width = values.itemsize * int(np.prod(values.shape[1:], dtype=np.int64))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(np.ascontiguousarray(cuts, np.int64) * width), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def encoded(docs: DataFrame, text_col: str, path: str) -> DataFrame:
    """``docs`` with the ids of each text in 16 bits, and how many they are; as it is, if it has them."""
    if "ids" in docs.columns:
        return docs

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offsets in pieces(b[text_col]):
                part = b.slice(i, j - i)
                ids, at = _encode(data, offsets, path)
                yield pa.RecordBatch.from_arrays([*part.columns, _packed(ids.astype(np.uint16), at), pa.array(np.diff(at))], [*part.schema.names, "ids", "size"])

    kinds = ", ".join(f"`{n}` {kind}" for n, kind in docs.dtypes)
    return docs.mapInArrow(add, f"{kinds}, ids binary, size bigint")


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in a row, and the offset of each."""
    column = column.cast(pa.large_binary())
    if len(column) == 0:
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint16, (at[-1] - at[0]) // 2, int(at[0])).astype(np.int64), (at - at[0]) // 2


def counts(training: DataFrame, text_col: str, path: str) -> DataFrame:
    """(kind, key, n) over all training texts: kind 0 words by hash, 1 id pairs as previous << 32 | id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], []]

        def flush() -> Iterator[pa.RecordBatch]:
            for kind in (0, 1):
                if held[kind]:
                    key, n = np.unique(np.concatenate(held[kind]), return_counts=True)
                    held[kind].clear()
                    for i in range(0, len(key), 1 << 16):
                        k = key[i : i + (1 << 16)]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k), pa.array(n[i : i + (1 << 16)])], ["kind", "key", "n"])

        size = 0
        for b in batches:
            for i, j, data, offsets in pieces(b[0]):
                held[0].append(word_hashes(LOWER[data], offsets)[3].view(np.int64))
                ids, at = _ids(b[1].slice(i, j - i))
                held[1].append(previous(ids, at) << 32 | ids)
                size += len(ids)
                if size > FLUSH:
                    yield from flush()
                    size = 0
        yield from flush()

    return encoded(training, text_col, path).select(text_col, "ids").mapInArrow(count, "kind int, key bigint, n bigint").groupBy("kind", "key").agg(F.sum("n").alias("n"))


_rooms: dict[tuple, np.ndarray] = {}


def _room(name: str, kind: np.dtype, *shape: int) -> np.ndarray:
    """An array to write into, the same for each call in a process: fresh memory for every step costs as much as the sums."""
    key = name, kind, len(shape), shape[1:]
    have = _rooms.get(key)
    if have is None or len(have) < shape[0]:
        have = _rooms[key] = np.empty(shape, kind)
    return have[: shape[0]]


@dataclass
class Model:
    bucket: np.ndarray  # (VOCABULARY,) bucket of each id; the last bucket is shared
    group: np.ndarray  # (IDS,) class of each bucket
    pair: np.ndarray  # (IDS, IDS) log P(bucket | previous bucket)
    within: np.ndarray  # (VOCABULARY,) log P(id | bucket)
    group_pair: np.ndarray  # (IDS, CLASSES) log P(class | previous bucket)
    embed: np.ndarray
    place: np.ndarray
    q: np.ndarray
    k: np.ndarray
    v: np.ndarray
    out: np.ndarray  # (WIDTH, CLASSES)

    def __post_init__(self):
        self._mask = np.tri(WINDOW, dtype=np.float32)
        # Queries meet keys, and values meet the classes, in one product of their weights each.
        w = np.concatenate([self.q @ self.k.T / np.sqrt(WIDTH), np.eye(WIDTH)], axis=1)
        self._tokens, self._places = (self.embed @ w).astype(np.float32), (self.place @ w).astype(np.float32)
        far = [np.abs(q[:, :WIDTH] @ k[:, WIDTH:].T).max() for q in (self._tokens, self._places) for k in (self._tokens, self._places)]
        self._near = bool(sum(far) < 60)
        self._group_pair, self._out = self.group_pair.astype(np.float32), (self.v @ self.out).astype(np.float32)

    def log_probabilities(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Natural logs of each id's probability given the ids before it in its text."""
        b = self.bucket.take(ids)
        x = self.bucket.take(previous(ids, offsets))
        result = self.pair.reshape(-1).take(x * IDS + b) + self.within.take(ids)
        size, group = np.diff(offsets), self.group.take(b)
        windows = 1 + np.maximum(0, -(-(size - WINDOW) // STRIDE))
        text = np.repeat(np.arange(len(size)), windows)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
        start, end = offsets[text] + nth * STRIDE, offsets[text + 1]
        steps, room = np.arange(WINDOW), lambda name, *shape: _room(name, np.float32, *shape)
        ones, classes = np.ones(WINDOW, np.float32), np.ones(CLASSES, np.float32)
        full = start + WINDOW <= end
        # A text's first window scores all of its ids, later ones only those beyond the overlap.
        for own, low, whole in ((np.flatnonzero(((nth > 0) == later) & (full == whole)), low, whole) for later, low in ((False, 0), (True, WINDOW - STRIDE)) for whole in (True, False)):
            for i in range(0, len(own), TOGETHER):
                w = own[i : i + TOGETHER]
                at = start[w, None] + steps
                xs = x.take(at, mode="clip")
                both = self._tokens.take(xs, 0, out=room("both", len(w), WINDOW, 2 * WIDTH), mode="clip")
                both += self._places
                q, v = both[:, low:, :WIDTH], both[..., WIDTH:]
                a = np.matmul(q, v.transpose(0, 2, 1), out=room(f"a{low}", len(w), WINDOW - low, WINDOW))
                if not self._near:
                    np.clip(a, -60, 60, out=a)
                np.exp(a, out=a)
                a *= self._mask[low:]
                h = np.matmul(a, v, out=room(f"h{low}", len(w), WINDOW - low, WIDTH)).reshape(-1, WIDTH)
                h /= (a.reshape(-1, WINDOW) @ ones).reshape(-1, 1)
                now, before = at[:, low:].reshape(-1), xs[:, low:].reshape(-1)
                if not whole:
                    scored = np.flatnonzero(at[:, low:] < end[w, None])
                    now, before, h = now[scored], before[scored], h[scored]
                base = self._group_pair.take(before, 0, out=room("base", len(now), CLASSES), mode="clip")
                z = np.matmul(h, self._out, out=room("z", len(now), CLASSES))
                g = group.take(now) + np.arange(0, len(now) * CLASSES, CLASSES)
                gain = z.reshape(-1).take(g)
                z += base
                np.exp(z, out=z)
                result[now] += gain - np.log(z @ classes)
        return result


def corpus_model(pairs: DataFrame, path: str) -> Model:
    """The model before the attention layer is trained: tables of at most IDS * IDS numbers, summed by Spark."""
    ids = pairs.select(F.shiftright("key", 32).alias("a"), F.col("key").bitwiseAND(F.lit((1 << 32) - 1)).alias("b"), "n")
    single = ids.groupBy("b").agg(F.sum("n").alias("n")).toPandas()  # at most VOCABULARY rows
    n = np.zeros(VOCABULARY)
    n[single.b.to_numpy(dtype=np.int64)] = single.n.to_numpy()
    top = np.lexsort((np.arange(VOCABULARY), -n))[: IDS - 1]
    if END not in top:
        top[-1] = END
    bucket = np.full(VOCABULARY, IDS - 1, dtype=np.int64)
    bucket[np.sort(top)] = np.arange(IDS - 1)
    lookup = pairs.sparkSession.createDataFrame([(int(i), int(bucket[i])) for i in top], "id bigint, bucket bigint")
    joined = ids.join(F.broadcast(lookup.toDF("a", "x")), "a", "left").join(F.broadcast(lookup.toDF("b", "y")), "b", "left")
    table = np.zeros((IDS, IDS))
    rows = joined.groupBy(F.coalesce("x", F.lit(IDS - 1)).alias("x"), F.coalesce("y", F.lit(IDS - 1)).alias("y")).agg(F.sum("n").alias("n")).toArrow()
    table[rows["x"].to_numpy(), rows["y"].to_numpy()] = rows["n"].to_numpy()
    shared = bucket == IDS - 1
    within = np.zeros(VOCABULARY)
    within[shared] = np.log((n[shared] + 0.5) / (n[shared] + 0.5).sum())
    alone = (table.sum(axis=0) + 0.5) / (table.sum() + 0.5 * IDS)
    # Pairs fall back to single counts in the share of distinct successors (Witten-Bell).
    total, kinds = table.sum(axis=1, keepdims=True), (table > 0).sum(axis=1, keepdims=True) + 1
    pair = (table + kinds * alone) / (total + kinds)
    # Classes: the most frequent buckets alone, the rest by whether they begin a word and by their bytes.
    e = encoder(path)
    order = np.argsort(-alone, kind="stable")
    group = np.zeros(IDS, dtype=np.int64)
    single_classes = CLASSES // 2
    group[order[:single_classes]] = np.arange(single_classes)
    id_of = np.zeros(IDS, dtype=np.int64)
    id_of[bucket[np.sort(top)]] = np.sort(top)
    raw = lambda i: b"\xff" if i == IDS - 1 or id_of[i] == END else e.decode_single_token_bytes(int(id_of[i]))
    rest = sorted(order[single_classes:].tolist(), key=lambda i: (raw(i)[:1] != b" ", raw(i)))
    mass = np.cumsum(alone[rest])
    group[rest] = single_classes + np.minimum((mass / mass[-1] * (CLASSES - single_classes)).astype(np.int64), CLASSES - single_classes - 1)
    group_pair = np.stack([np.bincount(group, weights=row, minlength=CLASSES) for row in pair])
    rng = np.random.default_rng(0)
    random = lambda *shape: rng.normal(0, 0.2, shape)
    return Model(bucket, group, np.log(pair), within, np.log(group_pair + 1e-12), random(IDS, WIDTH), random(WINDOW, WIDTH), *(random(WIDTH, WIDTH) for _ in range(3)), np.zeros((WIDTH, CLASSES)))


_PARAMETERS = ("embed", "place", "q", "k", "v", "out")


_TRIANGLE = np.tri(WINDOW, dtype=np.float32)
_COLUMNS = np.tile(np.arange(WIDTH), WINDOW)


def gradients(p: dict[str, np.ndarray], group_pair: np.ndarray, xs: np.ndarray, ys: np.ndarray, valid: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
    """Summed gradients of the classes' cross entropy over windows of previous buckets and classes (n, WINDOW), and the sum of ``valid``, the weight of each id.

    Powers of e stay without division: what divides a row is applied to the narrow factors that meet it.
    """
    count, kind = len(xs), p["out"].dtype
    x, flat = xs.ravel(), lambda t: t.reshape(-1, t.shape[-1])
    size, room = len(x), lambda name, *shape: _room(name, kind, *shape)
    narrow = kind.type(1 / np.sqrt(WIDTH))
    # Queries meet keys, and values meet the classes, in one product of their weights each.
    meet, read = (p["q"] * narrow) @ p["k"].T, p["v"] @ p["out"]
    e = p["embed"].take(x, 0, out=room("e", size, WIDTH), mode="clip")
    e3 = e.reshape(count, WINDOW, WIDTH)
    e3 += p["place"]
    q = np.matmul(e, meet, out=room("q", size, WIDTH))
    q3, mask = q.reshape(count, WINDOW, WIDTH), _TRIANGLE.astype(kind, copy=False)
    a, own = _powers(lambda: np.matmul(q3, e3.transpose(0, 2, 1), out=room("a", count, WINDOW, WINDOW)), mask)
    h = flat(np.matmul(a, e3, out=room("h", count, WINDOW, WIDTH)))
    h /= own
    base = group_pair.take(x, 0, out=room("base", size, CLASSES), mode="clip")
    z, total = _powers(lambda: np.add(np.matmul(h, read, out=room("z", size, CLASSES)), base, out=room("z", size, CLASSES)))
    z.reshape(-1)[np.arange(0, size * CLASSES, CLASSES) + ys.ravel()] -= total[:, 0]
    share = valid.reshape(-1, 1) / total
    dh = np.matmul(z, read.T, out=room("dh", size, WIDTH))
    dh *= share / own
    # The sum of a * da over a row is that of h * dh.
    mean = np.multiply(h, dh, out=room("hdh", size, WIDTH)) @ np.ones(WIDTH, kind)
    dh3 = dh.reshape(count, WINDOW, WIDTH)
    ds = np.matmul(dh3, e3.transpose(0, 2, 1), out=room("ds", count, WINDOW, WINDOW))
    ds -= mean.reshape(count, WINDOW, 1)
    ds *= a
    dq = flat(np.matmul(ds, e3, out=room("dq", count, WINDOW, WIDTH)))
    de = np.matmul(dq, meet.T, out=room("de", size, WIDTH))
    for weights, met in ((a, dh3), (ds, q3)):
        de += flat(np.matmul(weights.transpose(0, 2, 1), met, out=room("dk", count, WINDOW, WIDTH)))
    dmeet = (dq.T @ e).T * narrow
    h *= share
    dread = (z.T @ h).T
    out = {"q": dmeet @ p["k"], "k": dmeet.T @ p["q"], "v": dread @ p["out"].T, "out": p["v"].T @ dread, "place": (np.ones(count, kind) @ de.reshape(count, WINDOW * WIDTH)).reshape(WINDOW, WIDTH)}
    at = np.repeat(x * WIDTH, WIDTH).reshape(count, -1)
    at += _COLUMNS
    out["embed"] = np.bincount(at.reshape(-1), de.reshape(-1), IDS * WIDTH).astype(kind).reshape(IDS, WIDTH)
    return out, float(valid.sum())


def _powers(made: Callable[[], np.ndarray], mask: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Powers of e of the numbers made, in their place, 0 outside the mask, and the sum of each row (n, 1), by a product, which is quicker than sums of short rows; where a sum is far off, rows are made again and led to 0."""
    t = made()
    ones = np.ones((t.shape[-1], 1), t.dtype)

    def raised() -> np.ndarray:
        np.exp(t, out=t)
        if mask is not None:
            np.multiply(t, mask, out=t)
        return t.reshape(-1, t.shape[-1]) @ ones

    with np.errstate(over="ignore", invalid="ignore"):
        total = raised()
    if t.size and not (total.min() > 1e-12 and total.max() < 1e12):
        t = made()
        if _wide(t):
            if mask is not None:
                t += np.where(mask > 0, 0, -1e9).astype(t.dtype)
            t -= t.max(axis=-1, keepdims=True)
        total = raised()
    return t, total


def _wide(t: np.ndarray) -> bool:
    """Whether powers of e of these numbers may leave the range of floats."""
    return bool(t.size) and not (t.max() < 60 and t.min() > -60)


_PLACES = mix64(np.arange(1, WINDOW + 2, dtype=np.uint64) * _U(0xD6E8FEB86659FD93)) | _U(1)


def _distinct(led: np.ndarray, n: np.ndarray, lists: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, counts, list) of distinct windows by list and then by hash; windows of one hash that don't stand side by side may stay apart."""
    with np.errstate(over="ignore"):
        h = np.zeros(len(led), np.uint64)
        for i, by in enumerate(_PLACES):
            h += (led[:, i].astype(np.int64).view(np.uint64) + _U(2)) * by
    h = mix64(h)
    of = (h % _U(lists)).astype(np.int64)
    order = np.lexsort((h, of))
    led, h, of = led[order], h[order], of[order]
    first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (led[1:] != led[:-1]).any(axis=1))) if len(led) else np.zeros(0, np.int64)
    return led[first], np.add.reduceat(n[order], first) if len(led) else n, of[first]


def windows(training: DataFrame, text_col: str, path: str, bucket: np.ndarray, rounds: int, deal: int) -> DataFrame:
    """(round, n, led, times): shares of the distinct windows of all texts: their number, their 16-bit buckets led by the one before each (-1 beyond a text's end), and how often each occurs."""
    training = encoded(training, text_col, path)
    size = training.agg(F.sum("size").alias("n")).first().n or 0
    parts = min(PARTS, max(1, -(-size // (WINDOW * rounds * GATHER))))
    shared = training.sparkSession.sparkContext.broadcast(bucket.astype(np.int16))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = np.cumsum(b["size"].to_numpy())
            # As many texts at once as have about a million ids.
            for low, high in zip(c := np.unique([0, *(np.searchsorted(sizes, np.arange(1 << 20, sizes[-1], 1 << 20)) + 1).tolist(), len(sizes)]) if len(sizes) else [], c[1:]):
                ids, at = _ids(b["ids"].slice(low, high - low))
                n = -(-np.diff(at) // WINDOW)
                text = np.repeat(np.arange(len(n)), n)
                start = at[text] + (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * WINDOW
                place = start[:, None] + np.arange(WINDOW)
                led = np.empty((len(start), WINDOW + 1), np.int16)
                led[:, 0] = shared.value[previous(ids, at)[start]]
                led[:, 1:] = np.where(place < at[text + 1, None], shared.value[ids].take(place, mode="clip"), -1)
                led, times, of = _distinct(led, np.ones(len(led), np.int64), parts * rounds)
                edge = np.append(np.flatnonzero(np.diff(of, prepend=-1)), len(of))
                yield pa.RecordBatch.from_arrays([pa.array(of[edge[:-1]].astype(np.int32)), _packed(led, edge), _packed(times, edge)], ["of", "led", "times"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def shares() -> Iterator[pa.RecordBatch]:
            own = pa.Table.from_batches(held)
            led, times = np.frombuffer(b"".join(own["led"].to_pylist()), np.int16).reshape(-1, WINDOW + 1), np.frombuffer(b"".join(own["times"].to_pylist()), np.int64)
            led, times, _ = _distinct(led, times, 1)
            edge = len(led) * np.arange((n := -(-len(led) // deal)) + 1) // n
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, own["of"][0].as_py() % rounds, np.int32)), pa.array(np.diff(edge)), _packed(led, edge), _packed(times, edge)], ["round", "n", "led", "times"])

        for b in batches:
            of = b["of"].to_numpy()
            for s, e in zip(edge := [*np.flatnonzero(np.diff(of, prepend=-1)).tolist(), b.num_rows], edge[1:]):
                if held and held[-1]["of"][0].as_py() != of[s]:
                    yield from shares()
                    held.clear()
                held.append(b.slice(s, e - s))
        if held:
            yield from shares()

    pieced = training.select("ids", "size").mapInArrow(cut, "of int, led binary, times binary")
    # A task takes the parts of one number in all rounds.
    return pieced.repartition(parts, F.floor(F.col("of") / rounds)).sortWithinPartitions("of").mapInArrow(gather, "round int, n bigint, led binary, times binary")


def _steps(flat: np.ndarray, split, tables: tuple, led: np.ndarray, times: np.ndarray, rate: float) -> np.ndarray:
    """The parameters after Adam steps over one share's windows."""
    group, group_pair = tables
    # Ten and a hundred times the usual means of gradients and of their squares.
    m1, m2 = (np.zeros(len(flat), np.float32) for _ in range(2))
    flat = flat.copy()
    weight = (led[:, 1:] >= 0) * times.astype(np.float32)[:, None]
    led = np.maximum(led, 0).astype(np.int64)
    for step, i in enumerate(range(0, len(led), BATCH), 1):
        part = led[i : i + BATCH]
        g, n = gradients(split(flat.astype(np.float32)), group_pair, part[:, :-1], group[part[:, 1:]], weight[i : i + BATCH])
        g = np.concatenate([g[name].ravel() for name in _PARAMETERS])
        g *= np.float32(1 / n)
        m1 *= np.float32(0.9)
        m1 += g
        m2 *= np.float32(0.99)
        g *= g
        m2 += g
        np.sqrt(m2, out=g)
        part_of = np.sqrt(0.01 / (1 - 0.99**step))
        g += np.float32(1e-8 / part_of)
        np.divide(m1, g, out=g)
        g *= np.float32(0.1 * rate / (1 - 0.9**step) / part_of)
        flat -= g
    return flat


def train(model: Model, training: DataFrame, text_col: str, path: str, rounds: int = ROUNDS, deal: int = DEAL, rate: float = 0.02) -> Model:
    """Rounds of Adam steps over all windows, taken by shares of windows and averaged by Spark."""
    spark = training.sparkSession
    tables = spark.sparkContext.broadcast((model.group, model.group_pair.astype(np.float32)))
    table = saved(windows(training, text_col, path, model.bucket, rounds, deal), "round", compression="zstd")
    sizes = [r["round"] for r in table.select("round").distinct().collect()]
    shapes = [(n, getattr(model, n).shape) for n in _PARAMETERS]
    ends = np.cumsum([0, *(int(np.prod(shape)) for _, shape in shapes)])
    split = lambda flat: {n: flat[a:b].reshape(shape) for (n, shape), a, b in zip(shapes, ends, ends[1:])}
    flat = np.concatenate([getattr(model, n).astype(np.float64).ravel() for n in _PARAMETERS])
    for at in sorted(sizes):
        # Rates fall from round to round.
        pace = rate * (1 - at / rounds)

        def taken(batches: Iterator[pa.RecordBatch], flat: np.ndarray = flat, pace: float = pace) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros(len(flat)), 0
            for b in batches:
                # One task takes several shares, one after another.
                for n, led, times in zip(b["n"].to_pylist(), b["led"], b["times"]):
                    own = np.frombuffer(led.as_buffer(), np.int16).reshape(n, WINDOW + 1), np.frombuffer(times.as_buffer(), np.int64)
                    total += n * _steps(flat, split, tables.value, *own, pace)
                    count += n
            if count:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat) + 1)), pa.array(np.append(total, count))], ["at", "v"])

        own = table.where(F.col("round") == at).select("n", "led", "times").mapInArrow(taken, "at bigint, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
        sums = np.zeros(len(flat) + 1)
        sums[own["at"].to_numpy()] = own["v"].to_numpy()
        flat = sums[:-1] / sums[-1]
    discard(table)
    return Model(model.bucket, model.group, model.pair, model.within, model.group_pair, *split(flat).values())


def _cutoff(words: DataFrame, common: int) -> int:
    """The least count that at most ``common`` words reach; there are few different counts."""
    reached, least = 0, 1 << 62
    for c, n in sorted(((r.c, r["count"]) for r in words.groupBy("c").count().collect()), reverse=True):
        reached += n
        if reached > common:
            break
        least = c
    return least


class _Common:
    """The broadcast counts: a table of slots answers most words, a binary search those whose slot another word has."""

    BITS = 23

    def __init__(self, hashes: np.ndarray, counts_: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.counts = hashes[order], counts_[order]
        self.slot = np.full(1 << self.BITS, -1, dtype=np.int32)
        self.slot[self._at(self.hashes)] = np.arange(len(hashes))

    def _at(self, h: np.ndarray) -> np.ndarray:
        return (h.view(np.uint64) & _U((1 << self.BITS) - 1)).astype(np.int64)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, count)."""
        if len(self.hashes) == 0:
            return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
        slot = self.slot.take(self._at(h))
        i = np.maximum(slot, 0)
        same = self.hashes.take(i) == h
        lost = np.flatnonzero((slot >= 0) & ~same)
        i[lost] = np.minimum(np.searchsorted(self.hashes, h[lost]), len(self.hashes) - 1)
        same[lost] = self.hashes[i[lost]] == h[lost]
        return same, self.counts.take(i)


_common: dict[str, _Common] = {}


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: int = 1, path: str | None = None, common: int = COMMON) -> DataFrame:
    """Per document: its id, held_out, n_tokens, n_known, train_tokens, base_score, score and model_score, all three log10."""
    path = path or default_path()
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), (remainder(F.col(id_col)) == held_out).alias("out"))
    plain = saved(encoded(plain, "text", path), compression="zstd")  # stays, as the result reads it
    training = plain.where(~F.col("out"))
    table = saved(counts(training, "text", path))
    words = table.where("kind = 0").select(F.col("key").alias("h"), F.col("n").alias("c"))
    ends = training.count()
    total = words.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n_all, v_all = (total.n or 0) + ends, total.v + (ends > 0)
    model = corpus_model(table.where("kind = 1"), path)
    model = train(model, training, "text", path) if n_all else model
    frequent = words.where(F.col("c") >= _cutoff(words, common)).toArrow()
    shared = spark.sparkContext.broadcast((model, frequent["h"].to_numpy(), frequent["c"].to_numpy()))
    least = np.log10(n_all + 0.5 * (v_all + 1)) if n_all else 0.0
    denominator, run = float(least), uuid.uuid4().hex
    mix = MIX if n_all else 0.0

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, h_common, c_common = shared.value
        if run not in _common:
            _common.clear()
            _common[run] = _Common(h_common, c_common)
        known = _common[run]
        for b in batches:
            for i, j, data, offsets in pieces(b["text"]):
                n = j - i
                row, _, _, h = word_hashes(LOWER[data], offsets)
                h = h.view(np.int64)
                found, c = known.find(h)
                tokens = np.bincount(row, minlength=n) + 1
                sums = np.bincount(row[found], weights=np.log10(c[found] + 0.5), minlength=n) + np.log10(ends + 0.5) - tokens * denominator
                seen = np.bincount(row[found], minlength=n) + (ends > 0)
                ids, at = _ids(b["ids"].slice(i, n))
                logs = m.log_probabilities(ids, at)
                begin = np.flatnonzero(heads(path).take(ids))
                sub = np.add.reduceat(logs, begin)
                last = ids[begin] == END
                alone = np.add.reduceat(sub, np.concatenate([[0], np.flatnonzero(last)[:-1] + 1])) / np.log(10)
                word, sub = sub[~last], np.log10((1 - mix) * np.exp(sub[last]) + mix * ends / max(n_all, 1))
                mixed = np.log10((1 - mix) * np.exp(word[found]) + mix * c[found] / max(n_all, 1))
                scores = sub + np.bincount(row[found], weights=mixed, minlength=n)
                rid = b["rid"].to_numpy()[i:j]
                yield pa.RecordBatch.from_arrays([pa.array(rid), b["id"].slice(i, n), b["out"].slice(i, n), pa.array(rid * -0x61C8864680B583EB), pa.array(np.ones(n, bool)), pa.array(tokens), pa.array(seen), pa.array(sums), pa.array(scores), pa.array(alone)], names)
                rare = np.flatnonzero(~found)
                of = row[rare]
                zero = np.zeros(len(rare))
                yield pa.RecordBatch.from_arrays([pa.array(rid[of]), b["id"].slice(i, n).take(pa.array(of)), b["out"].slice(i, n).take(pa.array(of)), pa.array(h[rare]), pa.array(np.zeros(len(rare), bool)), *(pa.array(zero.astype(np.int64)) for _ in range(2)), pa.array(zero), pa.array(word[rare] / np.log(10)), pa.array(zero)], names)

    names = ["rid", "id", "out", "h", "whole", "tokens", "known", "base", "score", "alone"]
    kind = dict(plain.dtypes)["id"]
    rows = plain.withColumn("rid", F.monotonically_increasing_id()).mapInArrow(scan, f"rid bigint, id {kind}, out boolean, h bigint, whole boolean, tokens bigint, known bigint, base double, score double, alone double")
    rows = rows.join(words, "h", "left") if total.v else rows.withColumn("c", F.lit(0).cast("bigint"))
    c = F.coalesce("c", F.lit(0))
    # A rare word's row brings the model's log10 probability of the word.
    own = F.when(c > 0, F.log10((1 - mix) * F.pow(F.lit(10.0), F.col("score")) + mix * c / max(n_all, 1))).otherwise(F.col("score") + float(np.log10(1 - mix)))
    parts = rows.withColumns({"known": F.col("known") + F.when(~F.col("whole") & (c > 0), 1).otherwise(0), "base": F.col("base") + F.when(F.col("whole"), 0.0).otherwise(F.log10(c + 0.5)), "score": F.when(F.col("whole") | F.lit(mix == 0), F.col("score")).otherwise(own)})
    done = parts.groupBy("rid", "id", "out").agg(*(F.sum(x).alias(x) for x in ("tokens", "known", "base", "score", "alone")))
    return done.select(F.col("id").alias(id_col), F.col("out").alias("held_out"), F.col("tokens").alias("n_tokens"), F.col("known").alias("n_known"), F.lit(n_all).cast("bigint").alias("train_tokens"), F.col("base").alias("base_score"), "score", F.col("alone").alias("model_score"))

"""Arrow text batches as numpy bytes, and vectorised word hashing, shared by the operators."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text handled at once inside a task; a longer single text is a piece of its own.
PIECE_BYTES = 2 << 20

_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply rounds), so that low bits depend on all bits."""
    x = np.asarray(x, dtype=np.uint64).copy()
    with np.errstate(over="ignore"):
        x ^= x >> _U(33)
        x *= _U(0xFF51AFD7ED558CCD)
        x ^= x >> _U(33)
        x *= _U(0xC4CEB9FE1A85EC53)
        x ^= x >> _U(33)
    return x


#: A random-looking 64-bit value for every byte, and the odd base of the polynomial.
BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(BASE, -1, 1 << 64)

#: Maps A-Z to a-z and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes that separate whitespace words: \x20 and \x09-\x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row and the offset of each; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def cuts(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive runs of rows."""
    data, offsets = text_bytes(column)
    for i, j in cuts(offsets, limit):
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]


_powers: dict[str, np.ndarray] = {}


def _power_table(base: int, key: str, n: int) -> np.ndarray:
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = max(n, PIECE_BYTES + 1)
        table = np.full(size, _U(base), dtype=np.uint64)
        table[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(table, out=table)
        if size > 8 * PIECE_BYTES:  # one very long text: don't keep its table
            return table
        have = _powers[key] = table
    return have


class PrefixHash:
    """hash(s, e) of any byte ranges of a buffer, equal for equal bytes wherever they stand; for ranges of under 1,024 bytes."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self._sums = np.zeros(n + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(BYTE_VALUES[data] * _power_table(BASE, "up", n + 1)[:n], out=self._sums[1:])
        self._down = _power_table(_INVERSE, "down", n + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self._sums[end] - self._sums[start]) * self._down[start]


    def all(self, size: int) -> np.ndarray:
        """The hashes of all ranges of ``size`` bytes, in order."""
        with np.errstate(over="ignore"):
            out = self._sums[size:] - self._sums[: len(self._sums) - size]
            out *= self._down[: len(out)]
        return out


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of each maximal run of non-separator bytes; runs never cross texts."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~separator[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = word[:-1]
    start = np.flatnonzero(word & (~before | edge[:n]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = word[1:]
    end = np.flatnonzero(word & (~after | edge[1:])) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return row, start, end


#: Bytes beyond which a word is hashed by XXH64: sums of powers are the same for some pairs of texts of 1,024 bytes or more.
LONG_WORD = 256


def _hashed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = mix64(PrefixHash(data)(start, end))
    long = np.flatnonzero(end - start > LONG_WORD)
    if len(long):
        import xxhash

        out[long] = [xxhash.xxh64_intdigest(data[s:e].tobytes(), 42) for s, e in zip(start[long].tolist(), end[long].tolist())]
    return out


def hash_of(word: bytes) -> int:
    """The hash that ``word_hashes`` gives a word."""
    data = np.frombuffer(word, dtype=np.uint8)
    return int(_hashed(data, np.array([0]), np.array([len(data)]))[0]) if len(data) else 0


def word_hashes(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end, 64-bit hash) of each word."""
    row, start, end = word_spans(data, offsets, separator)
    if len(row) == 0:
        return row, start, end, np.zeros(0, np.uint64)
    return row, start, end, _hashed(data, start, end)


def shared_dir(spark) -> str:
    """The shared folder that the cluster names; a temporary one only where it is unset on a local master (tests)."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = tempfile.mkdtemp(prefix="spark-shared-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(where)
    return where

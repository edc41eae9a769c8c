"""Exact byte-pair encoding and decoding by dynamic programming over prefixes.

For every prefix of a pretoken the last token of its encoding is unique.  An automaton over the
vocabulary lists the tokens that end at a position; the one whose left neighbour (the last token of
the shorter prefix) is compatible with it, that is, which the merge order would not join or cut
differently across their border, is stored.  Following these back-pointers gives the ids.

Null text is empty: no ids, empty decoded text.  Repeated rows and other columns pass through;
an existing column with an output's name is replaced, as by ``withColumn``.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pretokens kept with their ids in a Python worker before its cache is emptied, and the letters of the longest kept.
CACHE_PRETOKENS, CACHE_LETTERS = 400_000, 64

#: The pretokeniser's pattern, as the vocabulary's public documentation states it.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printable letter: printable Latin-1 as it is, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class PrefixBPE:
    """Vocabulary, merge order and automaton of one tokenizer file."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        to_bytes = lambda w: bytes(letters[c] for c in w)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        # A token's rank: single bytes first, then tokens in the order in which merges make them.
        rank: dict[str, int] = {}
        for letter in letters:
            rank[letter] = len(rank)
        self.joined: dict[tuple[int, int], int] = {}
        self.left, self.right = list(range(len(rank))), list(range(len(rank)))
        for a, b in merges:
            if a + b not in rank:
                rank[a + b] = len(rank)
                self.left.append(rank[a])
                self.right.append(rank[b])
            self.joined.setdefault((rank[a], rank[b]), rank[a + b])
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.id_of = np.zeros(len(rank), dtype="<u4")
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        self.automaton = ahocorasick.Automaton()
        for word, r in rank.items():
            self.id_of[r] = vocab[word]
            self.bytes_of[vocab[word]] = raw = to_bytes(word)
            self.automaton.add_word(raw.decode("latin-1"), (r, len(raw)))
        for word, i in self.added.items():
            self.bytes_of[i] = word.encode()
        self.automaton.make_automaton()
        self._pairs: dict[tuple[int, int], bool] = {}
        self._find = regex.compile(PRETOKEN).findall
        self._split = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")").split if self.added else None
        self._special = {w: int(i).to_bytes(4, "little") for w, i in self.added.items()}
        self._cache = _Cache(self.pretoken_ids)

    def compatible(self, a: int, b: int) -> bool:
        """True if the merges, run over the bytes of both, end with token a followed by token b.

        Undo the later of the two tokens' merges step by step; at each step, a merge across the
        border that comes before the one undone would have been made first.
        """
        known = self._pairs.get((a, b))
        if known is not None:
            return known
        x, y, bound, ok = a, b, len(self.left), True
        while True:
            made = self.joined.get((x, y))
            if made is not None and made < bound:
                ok = False
                break
            simple_x, simple_y = self.right[x] == x, self.left[y] == y
            if simple_x and simple_y:
                break
            # On the same rank the left one is merged first, so a merge with y's own rank still counts.
            if not simple_x and (simple_y or x > y):
                bound, x = x, self.right[x]
            else:
                bound, y = y + 1, self.left[y]
        if len(self._pairs) > CACHE_PRETOKENS:
            self._pairs.clear()
        self._pairs[(a, b)] = ok
        return ok

    def pretoken_ids(self, pretoken: str) -> bytes:
        """The ids of one pretoken as little-endian 32-bit integers."""
        raw = pretoken.encode("utf-8")
        n = len(raw)
        last, compatible = [-1] * (n + 1), self.compatible
        for at, (token, length) in self.automaton.iter(raw.decode("latin-1")):
            end = at + 1
            if last[end] >= 0:
                continue
            start = end - length
            if start == 0:
                ok = length == 1 or compatible(self.left[token], self.right[token]) or self._whole(token)
            else:
                ok = last[start] >= 0 and compatible(last[start], token)
            if ok:
                last[end] = token
        out, end = [], n
        while end > 0:
            token = last[end]
            out.append(token)
            end -= len(self.bytes_of[self.id_of[token]])
        return self.id_of[out[::-1]].tobytes()

    def _whole(self, token: int) -> bool:
        """True if the token's own bytes are encoded as this one token."""
        known = self._pairs.get((-1, token))
        if known is None:
            parts = [self._rank_of_byte(b) for b in self.bytes_of[self.id_of[token]]]
            while len(parts) > 1:
                made = [(self.joined.get(p, len(self.left)), i) for i, p in enumerate(zip(parts, parts[1:]))]
                best, i = min(made)
                if best == len(self.left):
                    break
                parts[i : i + 2] = [best]
            known = self._pairs[(-1, token)] = parts == [token]
        return known

    def _rank_of_byte(self, b: int) -> int:
        if not hasattr(self, "_byte_rank"):
            self._byte_rank = {self.bytes_of[self.id_of[r]][0]: r for r in range(256)}
        return self._byte_rank[b]

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit integers."""
        cache = self._cache
        if len(cache) > CACHE_PRETOKENS:
            cache.clear()
        if self._split is None or not any(w in text for w in self.added):
            return b"".join(map(cache.__getitem__, self._find(text)))
        return b"".join(self._special[part] if part in self.added else b"".join(map(cache.__getitem__, self._find(part))) for part in self._split(text) if part)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", errors="replace")


class _Cache(dict):
    def __init__(self, make):
        super().__init__()
        self._make = make

    def __missing__(self, pretoken: str) -> bytes:
        ids = self._make(pretoken)
        if len(pretoken) <= CACHE_LETTERS:
            self[pretoken] = ids
        return ids


_loaded: dict[str, PrefixBPE] = {}


def tokenizer(path: str) -> PrefixBPE:
    """One tokenizer for each file and Python process."""
    if path not in _loaded:
        _loaded[path] = PrefixBPE(path)
    return _loaded[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode(text: Column, path: str | None = None) -> Column:
    """The ids of a text column: array<int>."""
    path = path or default_path()

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        t = tokenizer(path)
        for column in batches:
            parts = [t.encode(x) if x else b"" for x in column.to_pylist()]
            ends = np.cumsum([0] + [len(p) // 4 for p in parts]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), dtype="<u4").astype(np.int32)))

    return ids(text)


def decode(ids: Column, path: str | None = None) -> Column:
    """The text of an array<int> column; null or empty ids give the empty text."""
    path = path or default_path()

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        t = tokenizer(path)
        for column in batches:
            yield pa.array(["" if x is None else t.decode(np.array(x, dtype=np.int64)) for x in column.to_pylist()], pa.string())

    return text(ids)


def digests(text: Column, path: str | None = None) -> Column:
    """struct<n_tokens, ids_sha256, decoded_sha256>: encodes, decodes the ids and hashes both, in one pass."""
    path = path or default_path()

    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def out(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        t, sha = tokenizer(path), hashlib.sha256
        for column in batches:
            n, a, b = [], [], []
            for x in column:
                x = x.as_py() or ""
                ids = t.encode(x)
                n.append(len(ids) // 4)
                a.append(sha(ids).hexdigest())
                b.append(sha(t.decode(np.frombuffer(ids, dtype="<u4")).encode()).hexdigest())
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"])

    return out(text)


def encode_documents(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with a column ``ids`` (array<int>)."""
    return docs.withColumn("ids", encode(F.col(text_col), path))

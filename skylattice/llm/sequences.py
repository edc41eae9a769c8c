"""Token ids as Arrow files of equal-length sequences with masks, for random access without copying.

A file is an Arrow file (record batches and a footer that lists them) whose batches hold ``BATCH`` rows of ``ids``, a
fixed-size list of ``length`` unsigned integers, ``mask``, a fixed-size list of as many bits (0: padding behind the
file's last token), and ``begins``, the documents whose first token stands in the row, with its place.  Nothing is
compressed, so a memory map of a file is its sequences.  A text's ids are followed by one end id; documents stand in
ascending order of their id, within and across files, whole in one file, and may cross rows.

Writing is a Spark data source: each task sorts and encodes its own range of ids and writes one file under its own
name; the commit writes a manifest that lists the files of the tasks that succeeded, so a lost or repeated task leaves
nothing that a reader sees.  Reading deals out the files.

Null texts are empty: only an end id.  Null ids come first; rows of one id stand by the hash of their texts, and equal
rows all stay.  An empty table gives a manifest without files.  A single text is encoded in one task.  Columns beside
the id and the text aren't written.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from ._batch import pieces, shared_dir
from .bpe import default_path

#: Tokens of a sequence (a multiple of 8, so that masks begin on bytes) and rows of a record batch.
LENGTH, BATCH = 1024, 256

#: Chunks kept with their ids in a Python worker before its cache is emptied, and the letters of the longest kept.
CACHE_CHUNKS, CACHE_LETTERS = 600_000, 64

MANIFEST = "manifest.json"

#: The letters of Unicode's White_Space.
SPACES = "".join(map(chr, (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))

#: Chunks that can be encoded one by one: a byte-level vocabulary's pretokens don't go on from a letter to an ASCII
#: character that is none, nor from any other character to white space, and what a pretoken is depends on nothing before
#: it.  Words of Latin letters, then marks before white space, then white space with the run of characters behind it.
_LATIN = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f"
_chunks = re.compile(f" ?[{_LATIN}]+(?=[\\x00-\\x40\\x5b-\\x60\\x7b-\\x7f]|\\Z)|[.,;:!?)\"-]+(?=[{SPACES}]|\\Z)|[{SPACES}]*[^{SPACES}]+|[{SPACES}]+").findall


class _Known(dict):
    """The ids of chunks as little-endian integers, by the library where they aren't known yet."""

    def __init__(self, library, code: str):
        super().__init__()
        self._encode, self._code = library.encode, code

    def __missing__(self, chunk: str) -> bytes:
        ids = array(self._code, self._encode(chunk, add_special_tokens=False).ids)
        if sys.byteorder == "big":
            ids.byteswap()
        raw = ids.tobytes()
        if len(chunk) <= CACHE_LETTERS:
            self[chunk] = raw
        return raw


class Encoder:
    """Ids of texts by the tokenizers library, which sees each distinct chunk of the texts once."""

    def __init__(self, path: str):
        import tokenizers

        library = tokenizers.Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        self.width = np.dtype("<u2" if library.get_vocab_size() <= 1 << 16 else "<u4")
        self._known = _Known(library, "H" if self.width.itemsize == 2 else "I")

    def __call__(self, text: str) -> bytes:
        """The ids of a text as little-endian integers of ``width``."""
        if len(self._known) > CACHE_CHUNKS:
            self._known.clear()
        return b"".join(map(self._known.__getitem__, _chunks(text)))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each file and Python process."""
    if path not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        _encoders[path] = Encoder(path)
    return _encoders[path]


def file_schema(length: int, width: np.dtype, id_type: pa.DataType) -> pa.Schema:
    begins = pa.list_(pa.struct([("id", id_type), ("at", pa.int32())]))
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(width), length)), ("mask", pa.list_(pa.bool_(), length)), ("begins", begins)])


class _Rows:
    """Gathers documents into record batches of full sequences."""

    def __init__(self, schema: pa.Schema, length: int, width: np.dtype):
        self._schema, self._length, self._width = schema, length, width
        self._parts: list[bytes] = []
        self._begins: list[tuple[int, object]] = []
        self.tokens = self.documents = self._at = 0

    def add(self, ids: bytes, doc_id: object) -> Iterator[pa.RecordBatch]:
        self._begins.append((self._at, doc_id))
        self._parts.append(ids)
        n = len(ids) // self._width.itemsize
        self._at, self.tokens, self.documents = self._at + n, self.tokens + n, self.documents + 1
        if self._at >= BATCH * self._length:
            yield from self._cut(self._at // (BATCH * self._length) * BATCH)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self._at:
            yield from self._cut(-(-self._at // self._length))

    def _cut(self, rows: int) -> Iterator[pa.RecordBatch]:
        """The first rows as batches; what lies behind them stays."""
        end = rows * self._length
        ids = np.frombuffer(b"".join(self._parts), self._width)
        begins, kept = [b for b in self._begins if b[0] < end], [(at - end, d) for at, d in self._begins if at >= end]
        starts = np.array([at for at, _ in begins], np.int64)
        for first in range(0, rows, BATCH):
            n = min(BATCH, rows - first)
            piece = ids[first * self._length : (first + n) * self._length]
            room = n * self._length
            padded = np.zeros(room, self._width)
            padded[: len(piece)] = piece
            mask = np.packbits(np.arange(room) < len(piece), bitorder="little")
            lo, hi = np.searchsorted(starts, [first * self._length, (first + n) * self._length])
            row, at = np.divmod(starts[lo:hi], self._length)
            offsets = np.searchsorted(row, np.arange(first, first + n + 1))
            values = pa.StructArray.from_arrays([pa.array([d for _, d in begins[lo:hi]], self._schema.field("begins").type.value_type.field(0).type), pa.array(at, pa.int32())], fields=list(self._schema.field("begins").type.value_type))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.FixedSizeListArray.from_arrays(pa.array(padded), self._length).cast(self._schema.field("ids").type),
                    pa.FixedSizeListArray.from_arrays(pa.Array.from_buffers(pa.bool_(), room, [None, pa.py_buffer(mask)]), self._length).cast(self._schema.field("mask").type),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values).cast(self._schema.field("begins").type),
                ],
                schema=self._schema,
            )
        left = ids[end:].tobytes()
        self._parts, self._begins, self._at = [left] if left else [], kept, max(self._at - end, 0)


class _Written(WriterCommitMessage):
    def __init__(self, part: int, name: str, tokens: int, documents: int, sequences: int):
        self.part, self.name, self.tokens, self.documents, self.sequences = part, name, tokens, documents, sequences


def _place(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and path of a URI or a plain path."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
    return pyarrow.fs.LocalFileSystem(), path


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], id_type: pa.DataType):
        self._path, self._length, self._tokenizer, self._end, self._id_type = options["path"], int(options["length"]), options["tokenizer"], int(options["end_id"]), id_type

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        """One file of this task's rows (id, text), which come sorted."""
        from pyspark import TaskContext

        part, encode = TaskContext.get().partitionId(), encoder(self._tokenizer)
        fs, folder = _place(self._path)
        name = f"part-{part:06d}-{uuid.uuid4().hex}.arrow"
        schema = file_schema(self._length, encode.width, self._id_type)
        rows, end, n = _Rows(schema, self._length, encode.width), np.array([self._end], encode.width).tobytes(), 0
        try:
            with fs.open_output_stream(f"{folder}/{name}") as sink, pa.ipc.new_file(sink, schema) as out:
                for batch in batches:
                    for i, j, _, _ in pieces(batch.column(1)):
                        some = batch.slice(i, j - i)
                        for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                            for full in rows.add(encode(text or "") + end, doc_id):
                                out.write_batch(full)
                                n += full.num_rows
                for last in rows.rest():
                    out.write_batch(last)
                    n += last.num_rows
        except BaseException:
            self._remove(name)
            raise
        if not rows.documents:
            self._remove(name)
        return _Written(part, name, rows.tokens, rows.documents, n)

    def _remove(self, name: str) -> None:
        fs, folder = _place(self._path)
        if fs.get_file_info(f"{folder}/{name}").type != pyarrow.fs.FileType.NotFound:
            fs.delete_file(f"{folder}/{name}")

    def commit(self, messages: list[_Written | None]) -> None:
        """The manifest: files in order with the tokens and sequences before each.  A few numbers a file reach the driver."""
        files, tokens, sequences = [], 0, 0
        for m in sorted((m for m in messages if m is not None and m.documents), key=lambda m: m.part):
            files.append({"name": m.name, "tokens": m.tokens, "documents": m.documents, "sequences": m.sequences, "tokens_before": tokens, "sequences_before": sequences})
            tokens, sequences = tokens + m.tokens, sequences + m.sequences
        fs, folder = _place(self._path)
        with fs.open_output_stream(f"{folder}/{MANIFEST}") as f:
            f.write(json.dumps({"length": self._length, "tokens": tokens, "sequences": sequences, "files": files}).encode())

    def abort(self, messages: list[_Written | None]) -> None:
        for m in messages:
            if m is not None:
                self._remove(m.name)


class _File(InputPartition):
    def __init__(self, name: str, tokens_before: int):
        super().__init__(name)
        self.name, self.tokens_before = name, tokens_before


class _Reader(DataSourceReader):
    """(id, start, n_tokens, ids_crc32) of the documents of the files."""

    def __init__(self, path: str, schema: StructType):
        self._path, self._schema = path, schema

    def partitions(self) -> list[InputPartition]:
        return [_File(f["name"], f["tokens_before"]) for f in manifest(self._path)["files"]] or [_File("", 0)]

    def read(self, part: _File) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        if not part.name:
            return
        rows, out = [], to_arrow_schema(self._schema)
        for doc_id, start, n, crc in documents_of(self._path, part.name):
            rows.append((doc_id, part.tokens_before + start, n, crc))
            if len(rows) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), out.types)], schema=out)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), out.types)], schema=out)


class TokenSequences(DataSource):
    """``df.write.format("token_sequences")`` of rows (id, text) in order, and its documents read back."""

    @classmethod
    def name(cls) -> str:
        return "token_sequences"

    def schema(self) -> str:
        return f"id {self.options.get('id_type', 'bigint')}, start bigint, n_tokens bigint, ids_crc32 bigint"

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        from pyspark.sql.pandas.types import to_arrow_type

        return _Writer({"path": self.options["path"], "length": self.options.get("length", str(LENGTH)), "tokenizer": self.options["tokenizer"], "end_id": self.options.get("end_id", "0")}, to_arrow_type(schema[0].dataType))

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(self.options["path"], schema)


def manifest(path: str) -> dict:
    fs, folder = _place(path)
    with fs.open_input_stream(f"{folder}/{MANIFEST}") as f:
        return json.loads(f.read())


def _opened(path: str, name: str) -> pa.RecordBatchFileReader:
    """A file, mapped into memory where its file system is the local one."""
    fs, folder = _place(path)
    local = isinstance(fs, pyarrow.fs.LocalFileSystem)
    return pa.ipc.open_file(pa.memory_map(f"{folder}/{name}") if local else fs.open_input_file(f"{folder}/{name}"))


def _values(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The tokens and mask bits of a batch, without padding being cut."""
    ids = batch.column(0).flatten().to_numpy(zero_copy_only=True)
    return ids, batch.column(1).flatten().to_numpy(zero_copy_only=False)


def documents_of(path: str, name: str) -> Iterator[tuple[object, int, int, int]]:
    """(id, start in the file, tokens, crc32 of the ids as 32-bit integers) of a file's documents, batch by batch."""
    reader, at, open_ = _opened(path, name), 0, None
    for i in range(reader.num_record_batches):
        batch = reader.get_batch(i)
        ids, mask = _values(batch)
        size = int(np.count_nonzero(mask))
        raw = ids[:size].astype("<u4").tobytes()
        begins = batch.column(2)
        row = np.repeat(np.arange(batch.num_rows), np.diff(begins.offsets.to_numpy()))
        values = begins.flatten()
        starts = (row * (len(ids) // batch.num_rows) + values.field("at").to_numpy()).tolist()
        if open_ is not None:
            end = starts[0] if starts else size
            open_[2], open_[3] = open_[2] + end, zlib.crc32(raw[: 4 * end], open_[3])
        for doc_id, start, end in zip(values.field("id").to_pylist(), starts, [*starts[1:], size]):
            if open_ is not None:
                yield tuple(open_)
            open_ = [doc_id, at + start, end - start, zlib.crc32(raw[4 * start : 4 * end])]
        at += size
    if open_ is not None:
        yield tuple(open_)


class Sequences:
    """Random access: ``s[i]`` is (ids, mask) of the sequence i of all files, views of the mapped file."""

    def __init__(self, path: str):
        self._path, self._manifest = path, manifest(path)
        self._first = np.array([f["sequences_before"] for f in self._manifest["files"]], np.int64)
        self._open: dict[str, pa.RecordBatchFileReader] = {}

    def __len__(self) -> int:
        return self._manifest["sequences"]

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        if not 0 <= i < len(self):
            raise IndexError(i)
        k = int(np.searchsorted(self._first, i, side="right")) - 1
        name, row = self._manifest["files"][k]["name"], i - int(self._first[k])
        if name not in self._open:
            self._open[name] = _opened(self._path, name)
        batch = self._open[name].get_batch(row // BATCH)
        return batch.column(0)[row % BATCH].values.to_numpy(zero_copy_only=True), batch.column(1)[row % BATCH].values


def write(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = 0, tokenizer: str | None = None) -> None:
    """Writes the texts of ``docs`` to ``path`` (a folder that all executors reach), in ascending order of their ids."""
    if length % 8:
        raise ValueError("the length must be a multiple of 8")
    spark: SparkSession = docs.sparkSession
    spark.dataSource.register(TokenSequences)
    fs, folder = _place(path)
    fs.create_dir(folder, recursive=True)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("h", F.xxhash64("text"))
    # Rows of one id are also told apart by their texts' hashes, so that many of them go to several tasks.
    ordered = rows.repartitionByRange("id", "h").sortWithinPartitions("id", "h", "text").select("id", "text")
    ordered.write.format("token_sequences").mode("append").options(path=path, length=str(length), end_id=str(end_id), tokenizer=tokenizer or default_path()).save()


def documents(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document of the files at ``path``."""
    spark.dataSource.register(TokenSequences)
    return spark.read.format("token_sequences").options(path=path, id_type=id_type).load()


def new_folder(spark: SparkSession) -> str:
    """A new folder below the one that all executors share."""
    return f"{shared_dir(spark).rstrip('/')}/sequences-{uuid.uuid4().hex}"


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of ``docs``, read back from files written for it."""
    path = new_folder(docs.sparkSession)
    write(docs, path, id_col, text_col)
    return documents(docs.sparkSession, path, docs.schema[id_col].dataType.simpleString()).withColumnRenamed("id", id_col)

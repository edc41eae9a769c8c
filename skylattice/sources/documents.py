"""Writers of whole documents and of files by name, as data sources with a commit.

A document's texts come sorted by range; each task writes the run of every group it holds to a part file of its own, and
the commit joins the parts of all tasks in their order, a piece at a time, and puts the document in its place by a
rename.  Named files are written below a folder of the task's attempt and moved into place when the task ends well; an
abort deletes what its tasks moved.  So a failed task or job leaves nothing, and no text passes through a collect.

Paths are those of the local file system or of one that all executors mount.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: Bytes that the commit holds while it joins parts.
PIECE = 1 << 20


def _local(path: str) -> Path:
    return Path(path.removeprefix("file://") if path.startswith("file:///") else path.removeprefix("file:"))


class _Runs(WriterCommitMessage):
    def __init__(self, part: int, runs: list[tuple[str | None, str]]):
        self.part, self.runs = part, runs


class _DocumentWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self._path, self._job = _local(options["path"]), options["job"]
        self._head, self._tail, self._between = options["head"], options["tail"], options["between"]
        self._group_head, self._group_tail, self._group_between = options["groupHead"], options["groupTail"], options["groupBetween"]

    @property
    def _folder(self) -> Path:
        return self._path.parent / f".{self._path.name}-{self._job}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Runs:
        from pyspark import TaskContext

        part, mine = TaskContext.get().partitionId(), self._folder / uuid.uuid4().hex
        runs: list[tuple[str | None, str]] = []
        out = None
        try:
            for b in batches:
                for group, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if text is None:
                        continue
                    if out is None or runs[-1][0] != group:
                        if out is not None:
                            out.close()
                        mine.mkdir(parents=True, exist_ok=True)
                        runs.append((group, str(mine / str(len(runs)))))
                        out = open(runs[-1][1], "w", encoding="utf-8", newline="")
                    else:
                        out.write(self._between)
                    out.write(text)
        except BaseException:
            if out is not None:
                out.close()
            shutil.rmtree(mine, ignore_errors=True)
            raise
        if out is not None:
            out.close()
        return _Runs(part, runs)

    def commit(self, messages: list[_Runs | None]) -> None:
        self._folder.mkdir(parents=True, exist_ok=True)
        whole, last, first = self._folder / "document", object(), True
        with open(whole, "w", encoding="utf-8", newline="") as out:
            out.write(self._head)
            for m in sorted((m for m in messages if m is not None), key=lambda m: m.part):
                for group, name in m.runs:
                    if group != last:
                        out.write("" if first else self._group_tail + self._group_between)
                        out.write(self._group_head.replace("{group}", json.dumps(group, ensure_ascii=False)))
                    else:
                        out.write(self._between)
                    last, first = group, False
                    with open(name, encoding="utf-8", newline="") as part:
                        shutil.copyfileobj(part, out, PIECE)
            out.write(("" if first else self._group_tail) + self._tail)
        os.replace(whole, self._path)
        shutil.rmtree(self._folder)

    def abort(self, messages: list[_Runs | None]) -> None:
        shutil.rmtree(self._folder, ignore_errors=True)


class OneDocument(DataSource):
    """``df.write.format("one_document")`` of rows (group, text) in order."""

    @classmethod
    def name(cls) -> str:
        return "one_document"

    def writer(self, schema: StructType, overwrite: bool) -> _DocumentWriter:
        return _DocumentWriter({k: self.options[k] for k in ("path", "job", "head", "tail", "between", "groupHead", "groupTail", "groupBetween")})


def write_document(rows: DataFrame, path: str, order: list[Column], text: Column, group: Column | None = None, head: str = "", tail: str = "", between: str = "\n", group_head: str = "", group_tail: str = "", group_between: str = "") -> None:
    """One file of ``text`` in ``order``, with ``between`` between two texts of a group; null texts go.

    Rows are sorted by group first.  Each group stands between ``group_head``, in which {group} is its name as JSON, and
    ``group_tail``; ``head`` and ``tail`` enclose all.  Equal places in the order follow no rule.
    """
    rows.sparkSession.dataSource.register(OneDocument)
    target = _local(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    keyed = rows.select((F.lit(None) if group is None else group).cast("string").alias("_g"), text.cast("string").alias("_t"), *(c.alias(f"_o{i}") for i, c in enumerate(order)))
    keys = ["_g", *(f"_o{i}" for i in range(len(order)))]
    options = {"path": str(target), "job": uuid.uuid4().hex, "head": head, "tail": tail, "between": between, "groupHead": group_head, "groupTail": group_tail, "groupBetween": group_between}
    keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("_g", "_t").write.format("one_document").mode("append").options(**options).save()


class _Moved(WriterCommitMessage):
    def __init__(self, listed: str):
        self.listed = listed


class _FileWriter(DataSourceArrowWriter):
    def __init__(self, path: str, job: str):
        self._path, self._job = _local(path), job

    @property
    def _folder(self) -> Path:
        return self._path / f".{self._job}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Moved:
        mine = self._folder / uuid.uuid4().hex
        names: list[str] = []
        try:
            for b in batches:
                for name, content in zip(b.column(0).to_pylist(), b.column(1)):
                    at = Path(name)
                    if at.is_absolute() or ".." in at.parts:
                        raise ValueError(f"{name} isn't below the folder")
                    target = mine / "files" / at
                    target.parent.mkdir(parents=True, exist_ok=True)
                    target.write_bytes(content.as_buffer() if content.is_valid else b"")
                    names.append(name)
            if not names:
                return _Moved("")
            (mine / "names").write_text(json.dumps(names), encoding="utf-8")
            for name in names:
                target = self._path / name
                target.parent.mkdir(parents=True, exist_ok=True)
                os.replace(mine / "files" / name, target)
        except BaseException:
            shutil.rmtree(mine, ignore_errors=True)
            raise
        shutil.rmtree(mine / "files")
        return _Moved(str(mine / "names"))

    def commit(self, messages: list[_Moved | None]) -> None:
        shutil.rmtree(self._folder, ignore_errors=True)

    def abort(self, messages: list[_Moved | None]) -> None:
        for m in messages:
            if m is not None and m.listed and os.path.exists(m.listed):
                for name in json.loads(Path(m.listed).read_text(encoding="utf-8")):
                    (self._path / name).unlink(missing_ok=True)
        shutil.rmtree(self._folder, ignore_errors=True)


class NamedFiles(DataSource):
    """``df.write.format("named_files")`` of rows (name, content)."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def writer(self, schema: StructType, overwrite: bool) -> _FileWriter:
        return _FileWriter(self.options["path"], self.options["job"])


def write_files(rows: DataFrame, path: str) -> None:
    """A file for each row (name, content) below ``path``; a null content is an empty file, a name outside fails the write.

    Names are unique: of two rows of one name either may stay.
    """
    rows.sparkSession.dataSource.register(NamedFiles)
    _local(path).mkdir(parents=True, exist_ok=True)
    rows.select("name", F.col("content").cast("binary").alias("content")).write.format("named_files").mode("append").options(path=str(_local(path)), job=uuid.uuid4().hex).save()

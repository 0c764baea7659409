"""BibTeX as a Spark data source: ``spark.read.format("bibtex")`` and ``df.write.format("bibtex")``.

Reading plans splits of files by bytes: a split holds the records that begin in it, to their ends. Writing gives a file per
task in a folder of its own; the files move to their place when all tasks are done, and go if one fails.

``register(spark)`` makes the format known to a session. Paths are read by the file systems that Arrow knows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import Row, StructType

from .bibtex import parse_entry

SPLIT_BYTES = 32 << 20
_BLOCK = 1 << 20
#: A record begins with a line of this form; anything else that looks like one is text.
_BEGIN = re.compile(rb"(?m)^[ \t]*@\w+\s*\{")
_LONGEST_BEGIN = 256
SCHEMA = "source_file string, start bigint, entry_type string, cite_key string, fields map<string,string>"


def _file_system(path: str):
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _files(paths: list[str]) -> list[tuple[str, int]]:
    """Names and sizes of the files of paths, in order; hidden files of a folder are left out."""
    from pyarrow import fs

    out = []
    for path in paths:
        system, inner = _file_system(path)
        info = system.get_file_info(inner)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        if info.type == fs.FileType.File:
            out.append((path, info.size))
            continue
        prefix = path.rstrip("/")
        for own in sorted(system.get_file_info(fs.FileSelector(inner)), key=lambda x: x.path):
            if own.type == fs.FileType.File and not own.base_name.startswith(("_", ".")):
                out.append((f"{prefix}/{own.base_name}", own.size))
    return out


@dataclass
class Split(InputPartition):
    path: str
    first: int
    stop: int


def records(path: str, first: int, stop: int) -> Iterator[tuple[int, str]]:
    """``(byte place, text)`` of the records that begin in ``[first, stop)`` of a file."""
    system, inner = _file_system(path)
    with system.open_input_file(inner) as file:
        size = file.size()
        # from a little before, where the line of a record may begin
        at = max(first - _LONGEST_BEGIN - 1, 0)
        file.seek(at)
        held, base, ended = b"", at, False
        open_at = None  # place of the record that is being read
        while True:
            # what stands first may be the middle of a line, but for the record that is open
            found = (m for m in _BEGIN.finditer(held) if m.start() or base in (0, open_at))
            begins = [base + m.start() + m.group().index(b"@") for m in found]
            if not ended:
                begins = [b for b in begins if b < base + len(held) - _LONGEST_BEGIN]
            for place in begins:
                if open_at is not None and place > open_at:
                    yield open_at, held[open_at - base : place - base].decode("utf-8", "replace")
                    open_at = None
                if place >= stop:
                    return
                if place >= first:
                    open_at = place
            if ended:
                if open_at is not None:
                    yield open_at, held[open_at - base :].decode("utf-8", "replace")
                return
            # keep the open record, or what may be the beginning of one
            keep = open_at if open_at is not None else max(base, base + len(held) - _LONGEST_BEGIN)
            if open_at is None and keep > base:
                line = held.rfind(b"\n", 0, keep - base)
                keep = base + line if line >= 0 else keep
            if open_at is None and keep >= stop + _LONGEST_BEGIN:
                return
            more = file.read(_BLOCK)
            held, base = held[keep - base :] + more, keep
            ended = not more or base + len(held) >= size


class BibReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p for p in options["path"].split(",") if p]
        self.split = int(options.get("splitbytes", SPLIT_BYTES))

    def partitions(self) -> list[Split]:
        return [Split(path, at, min(at + self.split, size)) for path, size in _files(self.paths) for at in range(0, size, self.split)]

    def read(self, partition: Split) -> Iterator[tuple]:
        for place, text in records(partition.path, partition.first, partition.stop):
            kind, key, _, pairs = parse_entry(text)
            if kind is not None:
                yield (partition.path, place, kind, key, {p["k"]: p["v"] for p in pairs})


@dataclass
class Written(WriterCommitMessage):
    name: str
    rows: int


class BibWriter(DataSourceWriter):
    """One record a row of ``entry_type`` (or article), ``cite_key`` and ``fields``; values keep their braces balanced."""

    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.waiting = f"{self.path}/_waiting-{uuid.uuid4().hex}"
        missing = {"cite_key", "fields"} - set(schema.fieldNames())
        if missing:
            raise ValueError(f"columns are missing: {sorted(missing)}")

    def write(self, rows: Iterator[Row]) -> Written:
        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}.bib"
        system, inner = _file_system(f"{self.waiting}/{name}")
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        n = 0
        with system.open_output_stream(inner) as file:
            for row in rows:
                own = row.asDict()
                body = ",\n".join(f"  {k} = {{{v}}}" for k, v in (own["fields"] or {}).items() if v is not None)
                file.write(f"@{own.get('entry_type') or 'article'}{{{own['cite_key']},\n{body}\n}}\n\n".encode())
                n += 1
        return Written(name, n)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        system, folder = _file_system(self.path)
        _, waiting = _file_system(self.waiting)
        old = [x.path for x in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if x.type == fs.FileType.File] if self.overwrite else []
        for path in old:
            system.delete_file(path)
        for m in messages:
            if m is not None and m.rows:
                system.move(f"{waiting}/{m.name}", f"{folder}/{m.name}")
        self._clear(system, waiting)

    def abort(self, messages: list[Written | None]) -> None:
        system, waiting = _file_system(self.waiting)
        self._clear(system, waiting)

    @staticmethod
    def _clear(system, waiting: str) -> None:
        from pyarrow import fs

        if system.get_file_info(waiting).type == fs.FileType.Directory:
            system.delete_dir(waiting)


class BibSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bibtex"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> BibReader:
        return BibReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> BibWriter:
        return BibWriter(self.options, schema, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BibSource)

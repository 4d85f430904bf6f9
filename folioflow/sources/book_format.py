"""spark.read.format("book") and df.write.format("book"): the files of a folder, one row each.

Reading lists the folder, drops files by the filters on `page` and `name` before
any is opened, and deals the rest to partitions by size.  Writing is a two-phase
commit: tasks write files under names of their own in a staging folder, and only
when all have, the driver moves each over its target in one step, so a reader
sees the old text or the new one, and a failed job leaves the folder as it was.

Paths may be on any file system that pyarrow knows by its URI (local, s3, gs,
hdfs); the readers in books.py go through Spark's own and take any it knows.
"""

from __future__ import annotations

import datetime
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, StringEndsWith, StringStartsWith, WriterCommitMessage

#: Files that a partition reads: so many bytes, one file counting as this many at least.
PART_BYTES, FILE_BYTES = 8 << 20, 64 << 10
#: Which names are read (fixed values): canonical transcripts, files of a page, or all but hidden ones.
NAMES = {"canonical": r"page_(\d{3,})\.json", "page": r"page_(\d+)\..+", "all": r"(?:page_(\d+)\.)?[^.].*"}
SCHEMA = "page int, name string, modified timestamp, size long, body string"


def register(spark: SparkSession) -> SparkSession:
    """Makes the format known to a session and lets filters reach it."""
    spark.dataSource.register(BookFormat)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def _at(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and path.startswith("file:"):
        path = "file://" + path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


@dataclass
class Files(InputPartition):
    """(page, name, modified, size) of the files one task reads."""

    files: list


class BookFormat(DataSource):
    """Options: path (the folder), names (canonical, page or all; page by default), body (false: contents are not read)."""

    @classmethod
    def name(cls) -> str:
        return "book"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        missing = {"name", "body"} - set(schema.names)
        if missing:
            raise ValueError(f"files need the columns name and body; {sorted(missing)} missing")
        return _Writer(self.options["path"], [schema.names.index("name"), schema.names.index("body")], overwrite)


#: What a filter asks of a value; a null value passes none.
_TESTS = {EqualTo: lambda x, v: x == v, GreaterThan: lambda x, v: x > v, GreaterThanOrEqual: lambda x, v: x >= v, LessThan: lambda x, v: x < v, LessThanOrEqual: lambda x, v: x <= v, In: lambda x, v: x in v, StringStartsWith: lambda x, v: x.startswith(v), StringEndsWith: lambda x, v: x.endswith(v)}


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.body = options["path"], str(options.get("body", "true")).lower() != "false"
        kind = options.get("names", "page")
        if kind not in NAMES:
            raise ValueError(f"names must be one of {sorted(NAMES)}, not {kind!r}")
        self.pattern, self.tests = NAMES[kind], []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in ("page", "name") and isinstance(f, (IsNotNull, IsNull)):
                self.tests.append((column, type(f), None))
            elif column in ("page", "name") and type(f) in _TESTS:
                self.tests.append((column, type(f), f.value))
            else:
                yield f

    def _wanted(self, row: dict) -> bool:
        return all((row[c] is None) == (kind is IsNull) and (kind in (IsNotNull, IsNull) or _TESTS[kind](row[c], v)) for c, kind, v in self.tests)

    def partitions(self) -> list[Files]:
        where, folder = _at(self.path)
        found = []
        for info in where.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
            match = re.fullmatch(self.pattern, info.base_name)
            if info.is_file and match:
                row = {"page": int(match[1]) if match[1] else None, "name": info.base_name}
                if self._wanted(row):
                    found.append((row["page"], info.base_name, info.mtime, info.size))
        found.sort(key=lambda f: f[1])
        out, size = [], PART_BYTES
        for f in found:
            if size >= PART_BYTES:
                out.append(Files([]))
                size = 0
            out[-1].files.append(f)
            size += max(f[3], FILE_BYTES)
        return out or [Files([])]

    def read(self, partition: Files):
        where, folder = _at(self.path)
        for page, name, modified, size in partition.files:
            body = None
            if self.body:
                with where.open_input_stream(f"{folder}/{name}") as f:
                    body = f.read().decode("utf-8")
            yield page, name, modified.replace(tzinfo=modified.tzinfo or datetime.UTC), size, body


@dataclass
class Written(WriterCommitMessage):
    """(name, part) of the files one task wrote."""

    files: list


class _Writer(DataSourceWriter):
    def __init__(self, path: str, at: list[int], overwrite: bool):
        self.path, self.at, self.overwrite, self.staging = path, at, overwrite, f".staging-{uuid.uuid4().hex}"

    def write(self, rows) -> Written:
        where, folder = _at(self.path)
        stage, out = f"{folder}/{self.staging}/{uuid.uuid4().hex}", []
        where.create_dir(stage)
        for row in rows:
            name, body = (row[i] for i in self.at)
            if name is None or body is None or not re.fullmatch(r"[^/\x00]+", name) or name in (".", ".."):
                raise ValueError(f"a file needs a name without a folder, and a body: {name!r}")
            part = f"{stage}/{len(out)}"
            with where.open_output_stream(part) as f:
                f.write(body.encode())
            out.append((name, part))
        return Written(out)

    def commit(self, messages: list) -> None:
        where, folder = _at(self.path)
        files = [f for m in messages if m is not None for f in m.files]
        names = {name for name, _ in files}
        if len(names) < len(files):
            self.abort(messages)
            raise ValueError("two rows name the same file")
        for name, part in files:
            where.move(part, f"{folder}/{name}")
        self.abort(messages)  # the empty staging folder
        if self.overwrite:
            for info in where.get_file_info(pafs.FileSelector(folder)):
                if info.is_file and info.base_name not in names and not info.base_name.startswith("."):
                    where.delete_file(info.path)

    def abort(self, messages: list) -> None:
        """Nothing but the staging folder goes."""
        where, folder = _at(self.path)
        if where.get_file_info(f"{folder}/{self.staging}").type == pafs.FileType.Directory:
            where.delete_dir(f"{folder}/{self.staging}")

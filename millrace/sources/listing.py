"""A Spark data source that lists files without reading them, those of length zero too.

Its partitions are directories. The first levels are listed by the driver until there are
enough directories, the rest by tasks, each with what lies below its own. Spark's own file
sources leave out files of length zero, so these never show up as unreadable there.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone
from fnmatch import fnmatchcase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Directories that are enough for the tasks, and the most that the driver lists to find them.
DIRECTORIES, DRIVER_LISTS = 256, 64


def _opened(path: str):
    """File system and path in it, of a path or URI."""
    from pyarrow import fs

    if path.startswith("file:"):
        # One, two or three slashes: all are in use.
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _hidden(name: str) -> bool:
    return name.startswith((".", "_"))


def matches(name: str, glob: str) -> bool:
    """Whether a file name fits one of the alternatives ``{a,b}`` of a glob."""
    start, end = glob.find("{"), glob.find("}")
    if 0 <= start < end:
        return any(matches(name, glob[:start] + x + glob[end + 1 :]) for x in glob[start + 1 : end].split(","))
    return fnmatchcase(name, glob)


class Directory(InputPartition):
    """A directory, with all that lies below it or only with its own files; or given files."""

    def __init__(self, path: str, deep: bool):
        self.path, self.deep = path, deep


class _Lister(DataSourceReader):
    def __init__(self, options: dict):
        self.roots = options["path"].split("\n")
        self.glob = options.get("glob", "*")
        self.deep = options.get("recursive", "true") == "true"

    def partitions(self) -> list[Directory]:
        from pyarrow import fs

        open_, done, lists = list(self.roots), [], 0
        # A file given as a root is a partition of its own.
        while self.deep and open_ and len(open_) + len(done) < DIRECTORIES and lists < DRIVER_LISTS:
            path = open_.pop(0)
            system, at = _opened(path)
            if system.get_file_info(at).type != fs.FileType.Directory:
                done.append(Directory(path, False))
                continue
            lists += 1
            below = [i for i in system.get_file_info(fs.FileSelector(at)) if i.type == fs.FileType.Directory and not _hidden(i.base_name)]
            done.append(Directory(path, False))
            open_ += [f"{path.rstrip('/')}/{i.base_name}" for i in sorted(below, key=lambda i: i.base_name)]
        return done + [Directory(path, self.deep) for path in open_]

    def read(self, partition: Directory) -> Iterator[tuple]:
        from pyarrow import fs

        system, at = _opened(partition.path)
        here = system.get_file_info(at)
        if here.type == fs.FileType.NotFound:
            raise FileNotFoundError(partition.path)
        if here.type == fs.FileType.File:
            if matches(here.base_name, self.glob):
                yield partition.path, here.mtime, here.size
            return
        todo = [(at, partition.path.rstrip("/"))]
        while todo:
            folder, shown = todo.pop()
            for info in system.get_file_info(fs.FileSelector(folder)):
                if _hidden(info.base_name):
                    continue
                name = f"{shown}/{info.base_name}"
                if info.type == fs.FileType.File and matches(info.base_name, self.glob):
                    yield name, info.mtime or datetime.fromtimestamp(0, timezone.utc), info.size
                elif info.type == fs.FileType.Directory and partition.deep:
                    todo.append((info.path, name))


class FileListing(DataSource):
    """``spark.read.format("file_listing")``; options ``path`` (several parted by line ends),
    ``glob`` on file names, ``recursive``."""

    @classmethod
    def name(cls) -> str:
        return "file_listing"

    def schema(self) -> str:
        return "path string, modificationTime timestamp, length bigint"

    def reader(self, schema) -> DataSourceReader:
        return _Lister(dict(self.options))


def list_files(
    spark: SparkSession, path: str | list[str], glob: str | None = None, recursive: bool = True
) -> DataFrame:
    """``(path, modificationTime, length)`` of all files, empty ones too; nothing is opened.

    Hidden files and folders (``.`` or ``_`` in front) are left out, as Spark does; a path that
    is not there fails. Paths are local ones or of a store that Arrow knows (``s3://``,
    ``gs://``, ``hdfs://``). Tasks list the folders, so the driver never holds the names.
    """
    spark.dataSource.register(FileListing)
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.format("file_listing").option("path", "\n".join(paths)).option("recursive", str(recursive).lower())
    return (reader.option("glob", glob) if glob else reader).load()

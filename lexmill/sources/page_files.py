"""Folders of page files as a Python data source: ``spark.read.format("page_files")``, and the same for ``readStream``.

Options: ``path`` (a folder, not searched below, or several files parted by line ends), ``glob`` (``*.txt``), ``bytes`` (of files in
one partition; a larger file has a partition of its own), and for streams ``grace`` (seconds a file must be old, 1) and ``files`` (of one batch).
Files are found and read through pyarrow's file systems, so the folder may lie in any of them.  A document is known by its path; two
files with one stem stay apart.
"""

import fnmatch
import hashlib
import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "doc_id string, filename string, stem string, checksum_sha256 string, page_no long, text string, error string"
PARTITION = 64 << 20
Row = tuple[str, str, str, str | None, int | None, str | None, str | None]


@dataclass(frozen=True, order=True)
class Found:
    modified: int  # nanoseconds
    path: str
    size: int


@dataclass
class Files(InputPartition):
    """Files that one task reads."""

    paths: tuple[str, ...]


def file_system(where: str):
    """The file system of a path and the path in it; a path without a scheme is a local one."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(where) if "://" in where or where.startswith("file:") else (fs.LocalFileSystem(), where)


def listed(where: str, glob: str) -> list[Found]:
    """Files of a folder that match, or the files named; a missing one is an error."""
    from pyarrow import fs

    names = [n for n in where.split("\n") if n]
    system, first = file_system(names[0])
    infos = system.get_file_info([file_system(n)[1] for n in names])
    if len(names) == 1 and infos[0].type == fs.FileType.Directory:
        infos = [i for i in system.get_file_info(fs.FileSelector(first)) if i.type == fs.FileType.File and fnmatch.fnmatch(i.base_name, glob)]
    elif missing := [i.path for i in infos if i.type != fs.FileType.File]:
        raise FileNotFoundError(", ".join(missing))
    scheme = names[0][: len(names[0]) - len(first)] if names[0].endswith(first) else ""
    return sorted(Found(i.mtime_ns or 0, scheme + i.path, i.size or 0) for i in infos)


def packed(found: list[Found], most: int) -> list[Files]:
    """Neighbours by path share a partition up to ``most`` bytes."""
    out, held, size = [], [], 0
    for f in sorted(found, key=lambda f: f.path):
        if held and size + f.size > most:
            out.append(Files(tuple(held)))
            held, size = [], 0
        held.append(f.path)
        size += f.size
    return [*out, Files(tuple(held))] if held else out


def pages(path: str, content: bytes) -> list[str]:
    """The pages of a file: PDF where a library is installed, else UTF-8 text with form feeds between pages."""
    if not path.lower().endswith(".pdf"):
        return content.decode("utf-8").split("\f")
    from io import BytesIO

    from pypdf import PdfReader

    return [p.extract_text() or "" for p in PdfReader(BytesIO(content)).pages]


def read_files(part: Files) -> Iterator[Row]:
    """Rows of a partition; a file that cannot be read or decoded is one row with ``error``."""
    for path in part.paths:
        name = path.rsplit("/", 1)[-1]
        stem, digest = name.rsplit(".", 1)[0] or name, None
        try:
            system, inner = file_system(path)
            with system.open_input_stream(inner) as f:
                content = f.read()
            digest = hashlib.sha256(content).hexdigest()
            rows = [(path, name, stem, digest, i, text, None) for i, text in enumerate(pages(path, content), 1)]
        except Exception as e:  # one bad file doesn't end the run
            rows = [(path, name, stem, digest, None, None, f"{type(e).__name__}: {e}")]
        yield from rows


class PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.where, self.glob, self.most = options["path"], options.get("glob", "*.txt"), int(options.get("bytes", PARTITION))

    def partitions(self) -> list[Files]:
        return packed(listed(self.where, self.glob), self.most)

    def read(self, partition: Files) -> Iterator[Row]:
        return read_files(partition)


class PageStream(DataSourceStreamReader):
    """Offsets are (time of change, path): a batch is the files after one and up to another.

    Files younger than the grace wait, so that none with an earlier time appears behind an offset; one moved in with a time
    older than an offset that has passed is not seen.
    """

    def __init__(self, options: dict):
        self.where, self.glob, self.most = options["path"], options.get("glob", "*.txt"), int(options.get("bytes", PARTITION))
        self.grace, self.files = float(options.get("grace", 1)), int(options.get("files", 100_000))
        self.at = (0, "")

    def _between(self, start: tuple, end: tuple | None) -> list[Found]:
        return [f for f in listed(self.where, self.glob) if (f.modified, f.path) > start and (end is None or (f.modified, f.path) <= end)]

    def initialOffset(self) -> dict:
        return {"modified": 0, "path": ""}

    def latestOffset(self) -> dict:
        oldest = (time.time() - self.grace) * 1e9
        ready = [f for f in self._between(self.at, None) if f.modified <= oldest][: self.files]
        if ready:
            self.at = (ready[-1].modified, ready[-1].path)
        return {"modified": self.at[0], "path": self.at[1]}

    def partitions(self, start: dict, end: dict) -> list[Files]:
        self.at = max(self.at, (end["modified"], end["path"]))
        return packed(self._between((start["modified"], start["path"]), (end["modified"], end["path"])), self.most)

    def read(self, partition: Files) -> Iterator[Row]:
        return read_files(partition)

    def commit(self, end: dict) -> None:
        self.at = max(self.at, (end["modified"], end["path"]))


class PageFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "page_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(self.options)

    def streamReader(self, schema) -> PageStream:
        return PageStream(self.options)


def page_files(spark: SparkSession, where: str | list[str], glob: str = "*.txt", **options) -> DataFrame:
    """Pages of the files of a folder, or of listed files."""
    spark.dataSource.register(PageFiles)
    return spark.read.format("page_files").options(path=where if isinstance(where, str) else "\n".join(where), glob=glob, **options).load()

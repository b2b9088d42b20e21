"""Small files in the file system that Spark uses: read, list, and create exactly once."""

from __future__ import annotations

import gzip
import io
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusdeck.session import settings


TEXT_PIECE = 1 << 20


def place(spark: SparkSession, path: str):
    """(path, file system) as Hadoop objects."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system named, so that two spellings of a folder are equal."""
    found, files = place(spark, path.rstrip("/"))
    return files.makeQualified(found).toString()


def exists(spark: SparkSession, path: str) -> bool:
    found, files = place(spark, path)
    return files.exists(found)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file; None if there is no such file."""
    found, files = place(spark, path)
    if not files.exists(found):
        return None
    stream = files.open(found)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    found, files = place(spark, path)
    stream = files.create(found, True)
    try:
        # A long text goes to the JVM piece by piece, so that no copy of the whole is made there.
        for start in range(0, len(text), TEXT_PIECE):
            stream.write(bytearray(text[start : start + TEXT_PIECE], "utf-8"))
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with its content in one step; False if it is there already, whoever made it.

    The content is written under a name of its own and then given the final name. Local folders link it, which
    fails if the name is taken, as a rename does elsewhere (HDFS). Stores without an
    atomic rename need one run at a time.
    """
    found, files = place(spark, path)
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    write_text(spark, draft, text)
    first, _ = place(spark, draft)
    if files.getUri().getScheme() != "file":
        made = files.rename(first, found)
        if not made:
            files.delete(first, False)
        return made
    local = lambda p: p.toUri().getPath()
    try:
        os.link(local(first), local(found))
    except FileExistsError:
        return False
    finally:
        files.delete(first, False)
    return True


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Give a small file new content; in a local folder readers see the old or the new one, whole."""
    found, files = place(spark, path)
    if files.getUri().getScheme() != "file":
        write_text(spark, path, text)
        return
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    write_text(spark, draft, text)
    first, _ = place(spark, draft)
    os.replace(first.toUri().getPath(), found.toUri().getPath())


def make_folder(spark: SparkSession, path: str) -> None:
    found, files = place(spark, path)
    files.mkdirs(found)


def delete(spark: SparkSession, path: str) -> None:
    found, files = place(spark, path)
    files.delete(found, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none for a folder that is not there."""
    found, files = place(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(found)) if files.exists(found) else []


def sizes(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names and sizes of what lies in a folder; none for a folder that is not there."""
    found, files = place(spark, folder)
    return {s.getPath().getName(): s.getLen() for s in files.listStatus(found)} if files.exists(found) else {}


def modified(spark: SparkSession, path: str) -> int | None:
    """Time of the last change, in milliseconds, by the file system's clock."""
    found, files = place(spark, path)
    return files.getFileStatus(found).getModificationTime() if files.exists(found) else None


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern. Parts without a wildcard are looked up, not listed."""
    found, files = place(spark, pattern)
    return [s.getPath().toString() for s in files.globStatus(found) or []]


def file_key(path: str, root: str) -> str:
    """One spelling for a file's path; ``root`` goes before paths that name no file system."""
    whole = path if ":/" in path else f"{root}{path}"
    if whole.startswith("file:/") and not whole.startswith("file://"):
        return whole
    return "file:/" + whole[5:].lstrip("/") if whole.startswith("file:/") else whole


def file_key_column(path: Column, root: str) -> Column:
    """``file_key`` of a column."""
    whole = F.when(path.contains(":/"), path).otherwise(F.concat(F.lit(root), path))
    return F.regexp_replace(whole, "^file:/+", "file:/")


def default_root(spark: SparkSession) -> str:
    """What stands before the first slash of a path that names no file system."""
    uri = place(spark, "/")[1].getUri()
    return "file:" if uri.getScheme() == "file" else uri.toString().rstrip("/")


#: Folders and files are listed by so many tasks; by default there is one for each folder.
LISTING_TASKS = 64
# A task looks up at least so many files.
LEAST_LOOKUPS = 50
LISTING = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(LISTING_TASKS)}


def file_list(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, file_path) of files, listed by Spark without reading them; the second as readers report it."""
    with settings(spark, LISTING):
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return found.select("path", F.col("_metadata.file_path").alias("file_path"))


def _system(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:") or ":/" not in path:
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def hidden(name: str) -> bool:
    """Whether Spark's readers pass over files and folders of this name."""
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def uri(path: str) -> str:
    """A path with its file system, as Spark's readers report it: URI text, of which letters of other alphabets are a part."""
    whole = re.sub(r"^file:/+", "file:/", path)
    scheme, rest = whole.split(":", 1)
    spelled = quote(rest, safe="/_-!.~'()*,;:$&+=@")
    if not rest.isascii():
        other = lambda c: quote(c, safe="/_-!.~'()*,;:$&+=@") if c.isascii() or not c.isprintable() else c
        spelled = "".join(map(other, rest))
    return f"{scheme}:{spelled}"


def _empty(info: pafs.FileInfo) -> bool:
    return info.is_file and not info.size


def _entries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, modified, folder) of what lies right below folders, and of paths that are files."""
    for batch in batches:
        for root in batch.column(0).to_pylist():
            system, base = _system(root)
            whole = system.get_file_info(base)
            found = [whole] if whole.is_file else system.get_file_info(pafs.FileSelector(base))
            rows = [
                (root if info is whole else f"{root.rstrip('/')}/{info.base_name}", info.mtime_ns or 0, not info.is_file)
                for info in found
                if not (hidden(info.base_name) or _empty(info))
            ]
            for start in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[start : start + 10_000])], ["path", "modified", "folder"])


def _below(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, modified) of the files among the entries and of all files in the folders among them."""
    for batch in batches:
        rows = []
        for path, modified, folder in zip(*(column.to_pylist() for column in batch.columns)):
            if not folder:
                rows.append((path, modified))
                continue
            system, base = _system(path)
            for info in system.get_file_info(pafs.FileSelector(base, recursive=True)):
                inner = info.path[len(base.rstrip("/")) + 1 :]
                if info.is_file and not _empty(info) and not any(map(hidden, inner.split("/"))):
                    rows.append((f"{path}/{inner}", info.mtime_ns or 0))
        for start in range(0, len(rows), 10_000):
            columns = zip(*rows[start : start + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["path", "modified"])


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """(path, modified) of all files below a folder, or below the folders that a pattern matches.

    Tasks list the folders, so the driver holds no names; what Spark's readers pass over is left out.
    """
    roots = matching(spark, folder)
    if not roots:
        raise FileNotFoundError(folder)
    first = spark.createDataFrame([(root,) for root in roots], "path string")
    entries = first.mapInArrow(_entries, "path string, modified long, folder boolean")
    return entries.repartition(LISTING_TASKS).mapInArrow(_below, "path string, modified long")


def dealt_paths(spark: SparkSession, groups: list[list[str]]) -> DataFrame:
    """(task, paths) with one row, and one task, for each group of paths; ``unpacked`` reads them there.

    Paths of a batch have most of their text in common, so packed they take a small part of the driver's memory.
    """
    packed = [zlib.compress(json.dumps(group).encode(), 1) for group in groups]
    rows = pa.table({"task": pa.array(range(len(groups)), pa.int32()), "paths": pa.array(packed, pa.binary())})
    return spark.createDataFrame(rows).repartitionById(max(1, len(groups)), F.col("task"))


def unpacked(batch: pa.RecordBatch) -> list[list[str]]:
    return [json.loads(zlib.decompress(group)) for group in batch.column("paths").to_pylist()]


def _lengths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for paths in unpacked(batch):
            infos = [_system(path)[0].get_file_info(_system(path)[1]) for path in paths]
            if missing := [path for path, info in zip(paths, infos) if not info.is_file]:
                raise FileNotFoundError(missing[0])
            found.append([info.size for info in infos])
        yield pa.RecordBatch.from_arrays([batch.column("task"), pa.array(found, pa.list_(pa.int64()))], ["task", "lengths"])


def lengths(spark: SparkSession, paths: list[str]) -> list[int]:
    """The lengths of files, looked up by tasks."""
    share = max(LEAST_LOOKUPS, -(-len(paths) // LISTING_TASKS))
    groups = [paths[start : start + share] for start in range(0, len(paths), share)]
    found = dealt_paths(spark, groups).mapInArrow(_lengths, "task int, lengths array<long>").toArrow()
    return [n for part in found.sort_by("task").column("lengths").to_pylist() for n in part]


class _Random(io.RawIOBase):
    """An Arrow file under the rules of Python's own files, which archive readers rely on."""

    def __init__(self, path: str):
        system, place_ = _system(path)
        self._file = system.open_input_file(place_)

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self._file.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        start = {io.SEEK_SET: 0, io.SEEK_CUR: self._file.tell(), io.SEEK_END: self._file.size()}[whence]
        if start + offset < 0:
            raise OSError("seek before the start")
        self._file.seek(start + offset)
        return self._file.tell()

    def tell(self) -> int:
        return self._file.tell()

    def close(self) -> None:
        if not self.closed:
            self._file.close()
        super().close()


def open_input(path: str) -> io.BufferedReader:
    """A file for random reads, opened inside a task: local, HDFS or S3."""
    return io.BufferedReader(_Random(path), 1 << 18)


def open_text(path: str) -> io.TextIOWrapper:
    """A plain or gzip text file, opened inside a task."""
    data = open_input(path)
    packed = data.peek(2)[:2] == b"\x1f\x8b"
    return io.TextIOWrapper(gzip.GzipFile(fileobj=data) if packed else data, encoding="utf-8", errors="replace")


@contextmanager
def saving(path: str) -> Iterator[pa.NativeFile]:
    """Write a file inside a task, under a name of its own first that readers pass over; a repeated task writes it again."""
    system, place_ = _system(path)
    folder, name = place_.rsplit("/", 1)
    system.create_dir(folder, recursive=True)
    draft = f"{folder}/_{name}.{uuid.uuid4().hex}.draft"
    with system.open_output_stream(draft, compression=None) as out:
        yield out
    system.move(draft, place_)


def save(path: str, content: bytes) -> None:
    """Write the whole content of a file inside a task."""
    with saving(path) as out:
        out.write(content)

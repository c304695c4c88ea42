"""Folders of files: their names as a table, and a sink of one file for each row that leaves a run's files and no others."""

from __future__ import annotations

import fnmatch
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from clipwise.functions.signal import wav_bytes

from .audio import file_system


@dataclass
class Written(WriterCommitMessage):
    """A task's folder, and how many files it has."""

    folder: str
    files: int


class FileWriter(DataSourceArrowWriter):
    """Each attempt of a task writes to a folder of its own; the job takes those of the attempts that ended, and drops the rest.

    At its commit an overwriting job builds the new folder beside the old one and puts it in its place by two renames, so that a
    reader finds the old files or the new ones. An appending job moves its files in. The driver lists a
    task's files at a time and holds no names of all. A job that fails leaves the folder as it was.
    """

    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.name, self.content = options.get("name", "name"), options.get("content", "content")
        self.job = f"{file_system(self.path)[1]}._job-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        task = TaskContext.get()
        folder = f"{self.job}/{task.partitionId()}-{task.attemptNumber()}-{uuid.uuid4().hex[:8]}"
        store, _ = file_system(self.path)
        files = 0
        store.create_dir(folder, recursive=True)
        try:
            for batch in iterator:
                names, contents = (batch.column(batch.schema.get_field_index(c)) for c in (self.name, self.content))
                for name, content in zip(names.to_pylist(), contents, strict=True):
                    if not name or "/" in name or name[0] in "._" or not content.is_valid:
                        raise ValueError(f"a row without content, or whose name can't be a file's: {name!r}")
                    if store.get_file_info(f"{folder}/{name}").type != fs.FileType.NotFound:
                        raise ValueError(f"two rows are named {name}")
                    with store.open_output_stream(f"{folder}/{name}") as out:
                        out.write(content.as_buffer())
                    files += 1
        except BaseException:
            store.delete_dir(folder)
            raise
        return Written(folder, files)

    def commit(self, messages: list[Written | None]) -> None:
        store, target = file_system(self.path)
        into = f"{self.job}/_new" if self.overwrite else target
        try:
            store.create_dir(into, recursive=True)
            for message in messages:
                if message is None or not message.files:
                    continue
                for info in store.get_file_info(fs.FileSelector(message.folder)):
                    to = f"{into}/{info.base_name}"
                    if store.get_file_info(to).type != fs.FileType.NotFound:
                        raise ValueError(f"two rows are named {info.base_name}")
                    store.move(info.path, to)
            if self.overwrite:
                if store.get_file_info(target).type != fs.FileType.NotFound:
                    store.move(target, f"{self.job}/_old")
                store.move(into, target)
        finally:
            store.delete_dir(self.job)

    def abort(self, messages: list[Written | None]) -> None:
        store, _ = file_system(self.path)
        if store.get_file_info(self.job).type != fs.FileType.NotFound:
            store.delete_dir(self.job)


class FilePerRow(DataSource):
    """``df.write.format("file_per_row").option("name", …).option("content", …).mode(…).save(folder)``.

    ``name`` (a string) and ``content`` (binary) say which columns to take. With ``overwrite`` stale files go, with ``append`` they stay and a name
    that is there already raises. Names are unique; no rows and ``overwrite`` give an empty folder. For file systems with renames.
    """

    @classmethod
    def name(cls) -> str:
        return "file_per_row"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> FileWriter:
        return FileWriter(self.options, overwrite)


@dataclass
class Folder(InputPartition):
    path: str
    recursive: bool


class NameReader(DataSourceReader):
    """A task for each folder right under the path, and one for the files there; tasks list what lies below."""

    def __init__(self, options: dict[str, str]) -> None:
        path = options["path"].rstrip("/")
        head, _, tail = path.rpartition("/")
        self.path, self.pattern = (head, tail) if set(tail) & set("*?[") else (path, "*")

    def partitions(self) -> list[Folder]:
        store, root = file_system(self.path)
        below = [i.path for i in store.get_file_info(fs.FileSelector(root)) if i.type == fs.FileType.Directory]
        return [Folder(root, False), *[Folder(p, True) for p in sorted(below)]]

    def read(self, partition: Folder) -> Iterator[tuple]:
        store, _ = file_system(self.path)
        for info in store.get_file_info(fs.FileSelector(partition.path, recursive=partition.recursive)):
            if info.type == fs.FileType.File and fnmatch.fnmatchcase(info.base_name, self.pattern):
                yield info.path, info.base_name, info.size


class FileNames(DataSource):
    """``spark.read.format("file_names").load(folder)``: path, name and bytes of all files below a folder, empty ones too.

    Spark's own scans leave empty files out. The last part of the path may be a pattern of names. A folder that isn't there raises.
    """

    @classmethod
    def name(cls) -> str:
        return "file_names"

    def schema(self) -> str:
        return "path string, name string, bytes bigint"

    def reader(self, schema) -> NameReader:
        return NameReader(self.options)


def file_names(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(FileNames)
    return spark.read.format("file_names").load(path)


def write_files(df: DataFrame, path: str, name: str = "name", content: str = "content", mode: str = "overwrite") -> None:
    df.sparkSession.dataSource.register(FilePerRow)
    df.select(name, content).write.format("file_per_row").option("name", name).option("content", content).mode(mode).save(path)


def write_clips(clips: DataFrame, path: str, name: str = "name", samples: str = "samples", mode: str = "overwrite") -> None:
    """A 16-bit WAV file, ``<name>.wav``, for each row's samples; those of an earlier run go."""
    write_files(clips.select(F.concat(name, F.lit(".wav")).alias("name"), wav_bytes(samples).alias("content")), path, mode=mode)


def copy_files(names: DataFrame, source: str, target: str, path: str = "path", name: str = "name") -> None:
    """Copies the files under ``source`` that ``names`` lists by their ``path`` to ``target``, under their ``name``; a path that isn't there raises.

    The listing and the names meet by path before any content is read.
    """
    spark = names.sparkSession
    files = spark.read.format("binaryFile").load(source).select(F.col("path").alias("_path"), F.col("content"))
    wanted = names.select(F.col(path).alias("_path"), F.col(name).alias("name"))
    write_files(wanted.join(files, "_path", "left"), target)

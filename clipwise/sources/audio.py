"""PCM WAV files in blocks of frames, as a data source that seeks: a filter on files or times decides which bytes are read."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any, BinaryIO

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from clipwise.functions.signal import pcm

#: A block: its file's name, number of the first frame and its second, frames a second, channels, mono samples, bytes read for them.
BLOCKS = "file string, first bigint, start double, rate int, channels int, samples array<float>, bytes bigint"


@dataclass(frozen=True)
class Header:
    """What the chunks before the samples say: where samples start, how many frames there are, and their form."""

    offset: int
    frames: int
    rate: int
    channels: int
    width: int
    floating: bool


def header(f: BinaryIO, size: int) -> Header:
    """Reads the chunks of a RIFF file up to its samples. A data chunk that claims more than the file has ends with the file."""
    riff, _, wave = struct.unpack("<4sI4s", f.read(12))
    if riff != b"RIFF" or wave != b"WAVE":
        raise ValueError("not a WAV file")
    form, at = None, 12
    while at + 8 <= size:
        f.seek(at)
        name, length = struct.unpack("<4sI", f.read(8))
        if name == b"fmt ":
            body = f.read(min(length, 40))
            kind, channels, rate, _, _, bits = struct.unpack("<HHIIHH", body[:16])
            kind = struct.unpack("<H", body[24:26])[0] if kind == 0xFFFE and len(body) >= 26 else kind
            if kind not in (1, 3):
                raise ValueError(f"a WAV file of format {kind} isn't PCM")
            form = rate, channels, (bits + 7) // 8, kind == 3
        elif name == b"data":
            if form is None:
                raise ValueError("a WAV file without a format")
            rate, channels, width, floating = form
            return Header(at + 8, min(length, size - at - 8) // (channels * width), rate, channels, width, floating)
        at += 8 + length + length % 2
    raise ValueError("a WAV file without samples")


def read_frames(f: BinaryIO, h: Header, first: int, last: int) -> np.ndarray:
    """Mono samples of the frames from ``first`` to below ``last``; the only bytes read are theirs."""
    first, last = min(max(first, 0), h.frames), min(last, h.frames)
    step = h.channels * h.width
    f.seek(h.offset + first * step)
    raw = f.read(max(0, last - first) * step)
    return pcm(raw, h.width, h.floating).reshape(-1, h.channels).mean(axis=1, dtype=np.float32)


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Part(InputPartition):
    """Pieces of files: path, name, size, and the first and last byte (not included) of the piece."""

    pieces: list[tuple[str, str, int, int, int]]


class WavReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.block = int(options.get("blockframes", 16_000))
        self.split = int(options.get("splitbytes", 64 << 20))
        self.files: set[str] | None = None
        self.since, self.until = float("-inf"), float("inf")

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes files and the blocks' starts down. Spark checks starts again, as blocks are whole."""
        for f in filters:
            match f:
                case EqualTo(("file",), value):
                    self._only({value})
                case In(("file",), values):
                    self._only(set(values))
                case GreaterThan(("start",), value) | GreaterThanOrEqual(("start",), value):
                    self.since = max(self.since, float(value))
                    yield f
                case LessThan(("start",), value) | LessThanOrEqual(("start",), value):
                    self.until = min(self.until, float(value))
                    yield f
                case EqualTo(("start",), value):
                    self.since, self.until = max(self.since, float(value)), min(self.until, float(value))
                    yield f
                case _:
                    yield f

    def _only(self, names: set[Any]) -> None:
        self.files = names if self.files is None else self.files & names

    def partitions(self) -> list[Part]:
        """Pieces of at most ``splitBytes`` bytes, from the listing alone; small files share a task. No file is opened."""
        store, root = file_system(self.path)
        found = [i for i in store.get_file_info(fs.FileSelector(root)) if i.type == fs.FileType.File and i.base_name.lower().endswith(".wav")]
        parts: list[Part] = []
        held: list[tuple[str, str, int, int, int]] = []
        room = self.split
        for info in sorted(found, key=lambda i: i.base_name):
            if self.files is not None and info.base_name not in self.files:
                continue
            for low in range(0, max(info.size, 1), self.split):
                high = min(low + self.split, info.size)
                if held and high - low + 4096 > room:
                    parts.append(Part(held))
                    held, room = [], self.split
                held.append((info.path, info.base_name, info.size, low, high))
                room -= high - low + 4096  # opening a file counts as reading a page
        return [*parts, Part(held)] if held else parts

    def read(self, partition: Part | None) -> Iterator[pa.RecordBatch]:
        """Blocks whose first byte lies in a piece, and that the times leave."""
        if partition is None:
            return
        store, _ = file_system(self.path)
        for path, name, size, low, high in partition.pieces:
            with store.open_input_file(path) as f:
                h = header(f, size)
                step = h.channels * h.width
                begin = -(-max(0, low - h.offset) // (step * self.block))
                end = -(-min(max(0, high - h.offset), h.frames * step) // (step * self.block))
                if self.since > 0:
                    begin = max(begin, int(self.since * h.rate / self.block) - 1)
                if self.until < float("inf"):
                    end = min(end, int(max(self.until, -1.0) * h.rate / self.block) + 2)
                for b in range(begin, end):
                    first = b * self.block
                    start = first / h.rate
                    if self.since <= start <= self.until:
                        y = read_frames(f, h, first, first + self.block)
                        yield pa.record_batch(
                            [[name], pa.array([first], pa.int64()), [start], pa.array([h.rate], pa.int32()), pa.array([h.channels], pa.int32()), pa.array([y], pa.list_(pa.float32())), pa.array([len(y) * step], pa.int64())],
                            ["file", "first", "start", "rate", "channels", "samples", "bytes"],
                        )


class WavBlocks(DataSource):
    """``spark.read.format("wav_blocks").load(folder)``: the blocks of all WAV files in a folder.

    Options: ``blockFrames`` (16,000) and ``splitBytes`` (64 MiB). PCM of 8, 16, 24 or 32 bits and 32- or 64-bit floats; channels are
    averaged. Folders are those that the executors' pyarrow can open. An empty folder gives no rows, a file that isn't PCM WAV raises.
    """

    @classmethod
    def name(cls) -> str:
        return "wav_blocks"

    def schema(self) -> str:
        return BLOCKS

    def reader(self, schema) -> WavReader:
        return WavReader(self.options)


def wav_blocks(spark: SparkSession, path: str, *, block_frames: int = 16_000, split_bytes: int = 64 << 20) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WavBlocks)
    return spark.read.format("wav_blocks").option("blockFrames", block_frames).option("splitBytes", split_bytes).load(path)


RANGES = "samples array<float>, rate int, bytes bigint"


def read_ranges(requests: DataFrame, path: str = "path", start: str = "start", end: str = "end") -> DataFrame:
    """Requests with the ``samples`` of their file from ``int(start * rate)`` on, ``int((end - start) * rate)`` frames, and the rate.

    A file is opened once for requests of it that follow one another, and only the header and the frames asked for are read. Ranges
    are cut at the file's ends; a null path or time gives null samples. Columns named like an output are replaced.
    """
    added = ("samples", "rate", "bytes")
    keep = [c for c in requests.columns if c not in added]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.select(*[f"`{c}`" for c in keep]).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, f, h = None, None, None
        for batch in batches:
            asked = zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (path, start, end)), strict=True)
            samples, rates, sizes = [], [], []
            for p, a, b in asked:
                if p is None or a is None or b is None:
                    samples.append(None), rates.append(None), sizes.append(None)
                    continue
                if p != opened:
                    if f is not None:
                        f.close()
                    store, local = file_system(p)
                    f, opened = store.open_input_file(local), p
                    h = header(f, f.size())
                first = int(a * h.rate)
                y = read_frames(f, h, first, first + max(0, int((b - a) * h.rate)))
                samples.append(y), rates.append(h.rate), sizes.append(len(y) * h.channels * h.width)
            new = [pa.array(samples, pa.list_(pa.float32())), pa.array(rates, pa.int32()), pa.array(sizes, pa.int64())]
            yield pa.record_batch([*(batch.column(batch.schema.get_field_index(c)) for c in keep), *new], [*keep, *added])
        if f is not None:
            f.close()

    return requests.select(*[f"`{c}`" for c in keep]).mapInArrow(run, f"{fields}, {RANGES}")

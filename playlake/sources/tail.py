"""Tail of files that grow, as a streaming data source (SRC-6).

Spark's file streams take a file once; lines appended to it later never arrive. This source's offset is
the byte up to which each file has been read, so appended lines are the next batch's rows, and a restarted
query goes on at the byte its checkpoint names. Only whole lines are read: bytes after a file's last line feed
wait until the line is finished (or, with the option ``settled``, until the file has not changed for that many seconds).

Files only grow; one that became shorter than what has been read of it is an error. Names that start with ``.`` or
``_`` are passed over. A batch's new bytes are read in parallel by ranges of ``CHUNK`` bytes; a line belongs to the range in
which it begins. The path is a folder (or one file) on any store that pyarrow can open, the same for driver and
executors. The offset holds one number for each file.

Columns: value (the line without its line end), file, offset (byte at which the line begins).
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

CHUNK, BLOCK = 64 << 20, 1 << 20
_SCHEMA = "value string, file string, offset long"


@dataclass
class Span(InputPartition):
    """Lines of a file that begin in [low, high); bytes are read from ``begin`` to ``end``."""

    file: str
    begin: int
    end: int
    low: int
    high: int


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        if "path" not in options:
            raise ValueError("the tail_lines source needs a path")
        self.uri = options["path"]
        self.settled = float(options["settled"]) if "settled" in options else None
        self.chunk = int(options.get("chunk", CHUNK))
        self.seen: dict[str, tuple[int, int]] = {}

    def _open(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.uri)

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        fs, root = self._open()
        info = fs.get_file_info(root)
        if info.type == pafs.FileType.File:
            infos = [info]
        elif info.type == pafs.FileType.Directory:
            infos = fs.get_file_info(pafs.FileSelector(root, recursive=True))
        else:
            infos = []
        files = {}
        for f in sorted(infos, key=lambda f: f.path):
            inner = f.path[len(root):].split("/")
            if f.type != pafs.FileType.File or any(p.startswith((".", "_")) for p in inner if p):
                continue
            size, end = self.seen.get(f.path, (0, 0))
            if f.size < end:
                raise ValueError(f"{f.path} has become shorter than what was read of it")
            if f.size != size:
                end = self._last_line_end(fs, f.path, end, f.size)
                self.seen[f.path] = (f.size, end)
            if self.settled is not None and end < f.size and f.mtime and time.time() - f.mtime.timestamp() > self.settled:
                end = f.size
                self.seen[f.path] = (f.size, end)
            if end:
                files[f.path] = end
        return {"files": files}

    @staticmethod
    def _last_line_end(fs: pafs.FileSystem, path: str, low: int, high: int) -> int:
        """The byte after the last line feed in [low, high), or low."""
        with fs.open_input_file(path) as file:
            while high > low:
                begin = max(low, high - BLOCK)
                file.seek(begin)
                at = file.read(high - begin).rfind(b"\n")
                if at >= 0:
                    return begin + at + 1
                high = begin
        return low

    def partitions(self, start: dict, end: dict) -> list[Span]:
        out = []
        for path, stop in end["files"].items():
            begin = start["files"].get(path, 0)
            if stop < begin:
                raise ValueError(f"{path} has become shorter than what was read of it")
            for low in range(begin, stop, self.chunk):
                out.append(Span(path, begin, stop, low, min(low + self.chunk, stop)))
        return out

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        fs, _ = self._open()
        with fs.open_input_file(partition.file) as file:
            at, rest = partition.low, b""
            if partition.low > partition.begin:  # the line that runs into this range belongs to the one before
                at = self._next_line(file, partition.low - 1, partition.end)
            file.seek(at)
            begin = at  # where the unfinished line begins
            while begin < partition.high:
                block = file.read(min(BLOCK, partition.end - at)) if at < partition.end else b""
                at += len(block)
                lines = (rest + block).split(b"\n")
                rest = lines.pop()
                if not block:
                    if rest:  # a settled file may end without a line feed
                        yield self._rows(partition, [rest], [begin])
                    return
                starts, place = [], begin
                for line in lines:
                    starts.append(place)
                    place += len(line) + 1
                own = sum(s < partition.high for s in starts)
                if own:
                    yield self._rows(partition, lines[:own], starts[:own])
                begin = place

    @staticmethod
    def _next_line(file, at: int, end: int) -> int:
        """The byte after the first line feed at or after ``at``."""
        file.seek(at)
        while at < end:
            block = file.read(min(BLOCK, end - at))
            found = block.find(b"\n")
            if found >= 0:
                return at + found + 1
            at += len(block)
        return end

    @staticmethod
    def _rows(span: Span, lines: list[bytes], starts: list[int]) -> pa.RecordBatch:
        text = [line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines]
        return pa.RecordBatch.from_arrays(
            [pa.array(text, pa.string()), pa.array([span.file] * len(text), pa.string()), pa.array(starts, pa.int64())],
            ["value", "file", "offset"],
        )


class TailLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tail_lines"

    def schema(self) -> str:
        return _SCHEMA

    def streamReader(self, schema) -> TailReader:
        return TailReader(dict(self.options))


def tail_lines(spark: SparkSession, path: str, settled: float | None = None) -> DataFrame:
    """SRC-6: a stream of the whole lines of the files under ``path``, appended ones included."""
    spark.dataSource.register(TailLines)
    # a source in Python has no available-now trigger of its own; Spark's wrapper fixes the end and runs the last, empty batch
    spark.conf.set("spark.sql.streaming.triggerAvailableNowWrapper.enabled", "true")
    reader = spark.readStream.format("tail_lines").option("path", path)
    if settled is not None:
        reader = reader.option("settled", str(settled))
    return reader.load()

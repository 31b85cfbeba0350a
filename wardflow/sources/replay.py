"""Ordered replay of line-oriented files as a stream with positions of its own.

A position is a file and a byte at which a line starts.  A micro-batch takes the lines of the next
``batch_bytes``, planned as byte ranges that tasks read side by side; a line belongs to the range in
which its first byte lies.  Spark's checkpoint holds the positions between which a batch lies, so a
batch that failed half-way is planned again over the same lines, and the next one starts at the
line behind it.  As Spark asks for the next end without saying where it stands, the reader notes in
a folder every end that it has named: an empty file whose name is the position.

Lines come with their file and byte, which is their order; :func:`replay_csv` makes typed rows of
them with Spark's own CSV functions.
"""

from __future__ import annotations

import io
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Task code travels with its job, so executors need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of a micro-batch, of a task's range, and of an Arrow batch.
BATCH_BYTES, RANGE_BYTES, ARROW_BYTES = 1 << 30, 64 << 20, 4 << 20
LINES = pa.schema([("file", pa.string()), ("byte", pa.int64()), ("line", pa.string())])


@dataclass
class LineRange(InputPartition):
    file: str
    low: int
    high: int


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file:///"):
        path = "file://" + path[len("file:") :]
    return fs.FileSystem.from_uri(path)


def _next_line(store: fs.FileSystem, path: str, at: int) -> int:
    """The first line start at or behind ``at``; the size of the file if there is none."""
    if at == 0:
        return 0
    with io.BufferedReader(store.open_input_file(path)) as data:
        data.seek(at - 1)
        data.readline()
        return data.tell()


class ReplayReader(DataSourceStreamReader):
    """Files of one folder in the order of their names; they do not change once they are there."""

    def __init__(self, options: dict):
        self.folder, self.positions = options["path"], options["positions"]
        self.batch_bytes = int(options.get("batchbytes", BATCH_BYTES))
        self.range_bytes = int(options.get("rangebytes", RANGE_BYTES))

    def _files(self) -> list[tuple[str, int]]:
        store, root = _store(self.folder)
        found = store.get_file_info(fs.FileSelector(root))
        names = [(i.base_name, i.size) for i in found if i.type == fs.FileType.File]
        return sorted((n, s) for n, s in names if n[0] not in "._" and s)

    def _noted(self) -> list[tuple[str, int]]:
        store, root = _store(self.positions)
        infos = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        parts = (i.base_name.rsplit("@", 1) for i in infos if "@" in i.base_name)
        return sorted((name, int(byte)) for name, byte in parts)

    def initialOffset(self) -> dict:
        return {"file": "", "byte": 0}

    def latestOffset(self) -> dict:
        noted = self._noted()
        name, byte = noted[-1] if noted else ("", 0)
        left = self.batch_bytes
        store, root = _store(self.folder)
        for file, size in self._files():
            if file < name:
                continue
            at = byte if file == name else 0
            name, byte = file, min(size, at + left)
            left -= byte - at
            if left <= 0:
                byte = _next_line(store, f"{root}/{file}", byte)
                break
        if noted[-1:] != [(name, byte)] and name:
            store, root = _store(self.positions)
            store.create_dir(root, recursive=True)
            with store.open_output_stream(f"{root}/{name}@{byte:020d}"):
                pass
        return {"file": name, "byte": byte}

    def partitions(self, start: dict, end: dict) -> list[LineRange]:
        ranges = []
        for file, size in self._files():
            low = start["byte"] if file == start["file"] else 0
            high = end["byte"] if file == end["file"] else size
            if start["file"] <= file <= end["file"]:
                for at in range(low, high, self.range_bytes):
                    ranges.append(LineRange(file, at, min(at + self.range_bytes, high)))
        return ranges

    def commit(self, end: dict) -> None:
        """Positions before one that is done are not needed any more."""
        store, root = _store(self.positions)
        for name, byte in self._noted():
            if (name, byte) < (end["file"], end["byte"]):
                store.delete_file(f"{root}/{name}@{byte:020d}")

    def read(self, partition: LineRange) -> Iterator[pa.RecordBatch]:
        store, root = _store(self.folder)
        path = f"{root}/{partition.file}"
        at = _next_line(store, path, partition.low)
        places, lines, size = [], [], 0
        with io.BufferedReader(store.open_input_file(path), 1 << 20) as data:
            data.seek(at)
            while at < partition.high:
                line = data.readline()
                places.append(at)
                lines.append(line.rstrip(b"\r\n").decode("utf-8", "replace"))
                at += len(line)
                size += len(line)
                if size >= ARROW_BYTES:
                    yield self._batch(partition.file, places, lines)
                    places, lines, size = [], [], 0
        if lines:
            yield self._batch(partition.file, places, lines)

    @staticmethod
    def _batch(file: str, places: list[int], lines: list[str]) -> pa.RecordBatch:
        columns = [pa.array([file] * len(lines)), pa.array(places, pa.int64()), pa.array(lines)]
        return pa.RecordBatch.from_arrays(columns, schema=LINES)


class ReplaySource(DataSource):
    """``spark.readStream.format("ordered_lines")`` with options ``path`` and ``positions``."""

    @classmethod
    def name(cls) -> str:
        return "ordered_lines"

    def schema(self) -> str:
        return "file string, byte long, line string"

    def streamReader(self, schema) -> ReplayReader:
        return ReplayReader(self.options)


def replay_lines(
    spark: SparkSession, path: str, positions: str, batch_bytes: int = BATCH_BYTES,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Lines of the files below ``path``, with their file and byte, as a stream.

    ``positions`` belongs to the checkpoint of the one query that reads the stream.
    """
    spark.dataSource.register(ReplaySource)
    options = {"path": path, "positions": positions, "batchBytes": batch_bytes, "rangeBytes": range_bytes}
    return spark.readStream.format("ordered_lines").options(**options).load()


def replay_csv(lines: DataFrame, ddl: str, header: bool = True, **options) -> DataFrame:
    """Typed rows of CSV lines, one record a line, with ``replay_file`` and ``replay_byte``.

    With ``header`` the first line of each file is left out; blank lines have no row.
    """
    kept = lines.filter(F.length(F.trim("line")) > 0)
    if header:
        kept = kept.filter("byte > 0")
    row = F.from_csv("line", ddl, {k: str(v) for k, v in options.items()})
    parsed = kept.select(row.alias("row"), F.col("file").alias("replay_file"), F.col("byte").alias("replay_byte"))
    return parsed.select("row.*", "replay_file", "replay_byte")

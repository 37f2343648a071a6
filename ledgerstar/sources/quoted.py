"""Delimited text with quoted line breaks, read by byte ranges.

Whether a line break ends a record depends on all quotes before it, so Spark reads such a file by one task.
Here a first pass counts the quotes of each range of bytes, as one partition each of a Spark data
source. The sum of the counts of all earlier ranges, odd or even, says whether a range begins inside quotes. In a
second pass every range then finds its first record by itself, and reads on past its end until its last
record is whole. Records are parsed by Spark's own CSV expressions.

Counting is right only where quotes stand around a value or are doubled inside one. The first pass checks
that for both ways a range may begin. A file in which some quote stands elsewhere is read as a whole, and so are
compressed files and file systems that Arrow cannot open: by one task each, with the same rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RANGE_BYTES = 64 << 20
CHUNK = 8 << 20  # bytes that a task holds at once, beside an unfinished record
QUOTE, NEWLINE, COMMA, RETURN = (ord(x) for x in '"\n,\r')
COMPRESSED = (".gz", ".bz2", ".lz4", ".snappy", ".deflate", ".zst", ".xz")

COUNTED = "file int, start long, end long, quotes long, outside boolean, inside boolean, header string"


# Files ---------------------------------------------------------------------------------


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system and the path in it; ``file:/x`` is how Hadoop writes local paths."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def files(path: str) -> list[tuple[str, int]] | None:
    """Paths and sizes of a folder's data files, in order; null where ranges of bytes cannot be read."""
    try:
        system, inner = _filesystem(path)
        found = system.get_file_info(inner)
        if found.type == fs.FileType.Directory:
            found = system.get_file_info(fs.FileSelector(inner))
        elif found.type == fs.FileType.File:
            found = [found]
        else:
            return None  # a pattern, or nothing: Spark finds it or says so
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return None
    shown = [x for x in found if x.type == fs.FileType.File and not x.base_name.startswith(("_", "."))]
    if any(x.path.endswith(COMPRESSED) for x in shown):
        return None
    scheme = path.split("://")[0] + "://" if "://" in path else ""
    return sorted((scheme + x.path, x.size) for x in shown)


# Bytes ---------------------------------------------------------------------------------


def count(source, start: int, end: int) -> tuple[int, bool, bool]:
    """Quotes in ``[start, end)``, and whether they stand as they should for either way to begin."""
    quotes, ways = 0, [True, True]
    for at in range(start, end, CHUNK):
        upto = min(at + CHUNK, end)
        source.seek(max(at - 1, 0))
        data = np.frombuffer((b"" if at else b"\n") + source.read(upto - max(at - 1, 0) + 1), np.uint8)
        data = np.append(data, np.full(max(upto - at + 2 - len(data), 0), NEWLINE, np.uint8))
        places = np.flatnonzero(data[1 : upto - at + 1] == QUOTE) + 1
        before, behind = data[places - 1], data[places + 1]
        opens = (before == COMMA) | (before == NEWLINE) | (before == QUOTE)
        closes = (behind == COMMA) | (behind == NEWLINE) | (behind == QUOTE) | (behind == RETURN)
        for inside in (0, 1):
            odd = (np.arange(len(places)) + quotes + inside) % 2 == 1
            ways[inside] &= bool(np.where(odd, closes, opens).all())
        quotes += len(places)
    return quotes, ways[0], ways[1]


def records(source, start: int, end: int, inside: bool) -> Iterator[pa.Array]:
    """The records that begin in ``[start, end)``, without empty lines, in batches."""
    source.seek(max(start - 1, 0))
    position = max(start - 1, 0)
    if start:
        first = source.read(1)
        inside ^= first == b'"'  # the state before that byte
        source.seek(position)
    begin = 0 if start == 0 else None  # of the record at hand
    held: list[bytes] = []
    odd = int(inside)
    while chunk := source.read(CHUNK):
        data = np.frombuffer(chunk, np.uint8)
        parity = (np.cumsum(data == QUOTE) + odd) & 1
        odd = int(parity[-1])
        breaks = np.flatnonzero((data == NEWLINE) & (parity == 0))
        used = 0  # bytes of the chunk that need no second look
        if begin is None and len(breaks):
            used = int(breaks[0]) + 1
            begin, breaks = position + used, breaks[1:]
        if begin is not None:
            if begin >= end:
                return
            starts = np.append(begin, position + breaks + 1)
            whole = breaks[starts[:-1] < end]
            if len(whole):
                last = int(whole[-1]) + 1
                head = b"".join(held)
                yield _sliced(head + chunk[used:last], whole - used + len(head) + 1)
                held, used = [], last
                begin = position + last
                if begin >= end:
                    return
            held.append(chunk[used:])
        position += len(chunk)
    if begin is not None and (rest := b"".join(held)):
        yield _sliced(rest + b"\n", np.array([len(rest) + 1]))


def _sliced(data: bytes, ends: np.ndarray) -> pa.Array:
    """Lines of text, each ended by a line feed that goes; bytes that are not UTF-8 are replaced."""
    offsets = pa.py_buffer(np.append(0, ends).astype(np.int32).tobytes())
    lines = pa.Array.from_buffers(pa.binary(), len(ends), [None, offsets, pa.py_buffer(data)])
    lines = pc.binary_slice(lines, 0, -1)
    lines = lines.filter(pc.greater(pc.binary_length(lines), 0))
    try:
        return lines.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x.decode("utf-8", "replace") for x in lines.to_pylist()], pa.string())


# The data source ---------------------------------------------------------------------------


@dataclass
class Range(InputPartition):
    file: int
    path: str
    start: int
    end: int
    inside: bool = False


class _Ranges(DataSourceReader):
    def __init__(self, ranges: list[list], counting: bool):
        self.ranges, self.counting = ranges, counting

    def partitions(self):
        return [Range(*x) for x in self.ranges]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        system, inner = _filesystem(part.path)
        with system.open_input_file(inner) as source:
            if self.counting:
                yield _counted(part, source)
                return
            header = part.start == 0
            for lines in records(source, part.start, part.end, part.inside):
                if header and len(lines):
                    lines, header = lines[1:], False
                yield pa.RecordBatch.from_arrays([lines], names=["record"])


def _counted(part: Range, source) -> pa.RecordBatch:
    header = None
    if part.start == 0:
        filled = (lines[0].as_py() for lines in records(source, 0, part.end, False) if len(lines))
        header = next(filled, None)
    row = (part.file, part.start, part.end, *count(source, part.start, part.end), header)
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string())
    names = [x.split()[0] for x in COUNTED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(row, kinds)], names=names)


class QuotedText(DataSource):
    """Ranges of text files: their quotes, or their records."""

    @classmethod
    def name(cls) -> str:
        return "ledgerstar_quoted"

    def schema(self) -> str:
        return COUNTED if self.options["counting"] == "true" else "record string"

    def reader(self, schema) -> DataSourceReader:
        return _Ranges(json.loads(self.options["ranges"]), self.options["counting"] == "true")


def _load(spark: SparkSession, ranges: list[list], counting: bool) -> DataFrame:
    spark.dataSource.register(QuotedText)
    options = {"ranges": json.dumps(ranges), "counting": str(counting).lower()}
    return spark.read.format(QuotedText.name()).options(**options).load()


# Records -----------------------------------------------------------------------------------


@dataclass
class Split:
    """Ranges of regular files, the headers found in them, and the paths of all other files."""

    ranges: list[list]
    headers: list[str]
    irregular: list[str]


def split(spark: SparkSession, found: list[tuple[str, int]], range_bytes: int = RANGE_BYTES) -> Split:
    """Count quotes per range and tell how each begins; one row per range comes to the driver."""
    ranges = [
        [file, path, start, min(start + range_bytes, size)]
        for file, (path, size) in enumerate(found)
        for start in range(0, size, range_bytes)
    ]
    if not ranges:
        return Split([], [], [])
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    began = (
        _load(spark, ranges, True)
        .withColumn("began", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1)
        .withColumn("fits", F.when(F.col("began"), F.col("inside")).otherwise(F.col("outside")))
        .withColumn("regular", F.min("fits").over(whole) & (F.sum("quotes").over(whole) % 2 == 0))
        .select("file", "start", "end", "began", "regular", "header")
        .collect()
    )
    rows = sorted(began, key=lambda row: (row["file"], row["start"]))
    good = [row for row in rows if row["regular"]]
    return Split(
        [[row["file"], found[row["file"]][0], row["start"], row["end"], row["began"]] for row in good],
        sorted({row["header"] for row in good if row["header"] is not None}),
        sorted({found[row["file"]][0] for row in rows if not row["regular"]}),
    )


def parsed(spark: SparkSession, ranges: list[list], schema: str, options: dict[str, str]) -> DataFrame:
    """Records of the ranges as columns."""
    line: Column = F.from_csv("record", schema, options)
    return _load(spark, ranges, False).select(line.alias("row")).select("row.*")

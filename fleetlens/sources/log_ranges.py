"""Sections of aggregated container logs by byte ranges, with their offsets.

A Python data source (``format("container_logs")``): files are cut into byte
ranges, one task each. A section belongs to the range in which its header line
begins; its task reads on past the range's end until the next header, so a
section may span any number of ranges, and ranges without a header give none.
Only a line that has a container header's whole form begins a section, so content
lines like ``Container: - `` stay content without being put back afterwards.

``offset`` and ``length`` are bytes of the file from the header's first byte to
the next header, as written: reading them back gives the section. What stands
before a file's first header is no section.

A compressed file (.gz, .bz2, .zst, .lz4) cannot be entered in its middle: it is
one range, and its offsets count uncompressed bytes.

Files are opened through ``pyarrow.fs`` (local, HDFS, S3, GCS, ABFS). For other
stores use ``sources.logs.read_container_logs``, which reads through Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

import fleetlens.operators.udf  # noqa: F401  (package functions pickle by value)
from fleetlens.sources.logs import section_container_logs

NAME = "container_logs"
SCHEMA = "file string, offset bigint, length bigint, value string"
# A section's first line, and the endings of compressed files.
HEADER = re.compile(rb"^Container: [a-zA-Z0-9_]+ on [a-zA-Z0-9_]", re.MULTILINE)
# Hadoop's names of stores that pyarrow knows by another.
OTHER_NAMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4")

RANGE_BYTES = 128 << 20
READ_BYTES = 4 << 20
BATCH_BYTES = 8 << 20
#: A header's fixed part is found in this much of a line.
HEADER_BYTES = 4096


@dataclass
class LogRange(InputPartition):
    path: str
    start: int
    stop: int | None  # None: to the end of the file


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    scheme, mark, rest = path.partition("://")
    if mark:
        return fs.FileSystem.from_uri(f"{OTHER_NAMES.get(scheme, scheme)}://{rest}")
    local = path.removeprefix("file:")
    return fs.LocalFileSystem(), local


def is_compressed(path: str) -> bool:
    return path.endswith(COMPRESSED)


def log_files(path: str) -> list[tuple[str, int]]:
    """Files below a folder (or the file itself) and their sizes; names that
    begin with ``_`` or ``.`` are not data, as for Spark's readers."""
    store, inner = store_of(path)
    info = store.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    found = store.get_file_info(fs.FileSelector(inner, recursive=True))
    root = inner.rstrip("/")
    out = []
    for f in found:
        below = f.path[len(root):].lstrip("/")
        if f.type == fs.FileType.File and not any(p.startswith(("_", ".")) for p in below.split("/")):
            out.append((f"{path.rstrip('/')}/{below}", f.size))
    return sorted(out)


def sections(path: str, start: int, stop: int | None) -> Iterator[tuple[int, bytes]]:
    """``(offset, bytes)`` of the sections whose header begins in the range."""
    store, inner = store_of(path)
    # A stream is decompressed by its file's ending; a file can be entered anywhere.
    source = store.open_input_stream(inner) if is_compressed(path) else store.open_input_file(inner)
    with source:
        # The byte before the range tells whether a line begins with it.
        base = max(start - 1, 0)
        if base:
            source.seek(base)
        # ``held`` is the file from ``base`` on; ``opened`` and ``scanned`` are places in it.
        held, opened, scanned = bytearray(), None, 0
        while True:
            more = source.read(READ_BYTES)
            held += more
            # The last line may go on, and with it a header.
            sure = max(held.rfind(b"\n") + 1, len(held) - HEADER_BYTES, 0) if more else len(held)
            for found in HEADER.finditer(held, scanned):
                at = found.start()
                if at >= sure:
                    break
                if at == 0 and base:
                    continue  # not known to begin a line
                if opened is not None:
                    yield base + opened, bytes(held[opened:at])
                    opened = None
                if stop is not None and base + at >= stop:
                    return
                if base + at >= start:
                    opened = at
            scanned = max(sure, scanned)
            if not more:
                break
            if stop is not None and opened is None and base + scanned >= stop:
                return
            drop = opened if opened is not None else max(scanned - 1, 0)
            if opened is None or drop >= READ_BYTES:
                del held[:drop]
                base, scanned = base + drop, scanned - drop
                opened = None if opened is None else 0
        if opened is not None:
            yield base + opened, bytes(held[opened:])


class LogReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.range_bytes = int(options.get("rangebytes", RANGE_BYTES))

    def partitions(self) -> list[LogRange]:
        out = []
        for path, size in log_files(self.path):
            step = size if is_compressed(path) else self.range_bytes
            starts = range(0, max(size, 1), max(step, 1))
            out += [LogRange(path, s, None if is_compressed(path) else min(s + step, size)) for s in starts]
        return out

    def read(self, partition: LogRange) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, str]] = []
        size = 0

        def batch() -> pa.RecordBatch:
            offset, length, value = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([partition.path] * len(rows)), pa.array(offset, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(value, pa.string())], names=["file", "offset", "length", "value"])

        for offset, data in sections(partition.path, partition.start, partition.stop):
            text = data.decode(errors="replace").replace("\r\n", "\n")
            # The line end before the next header belongs to neither's text.
            rows.append((offset, len(data), text.removesuffix("\n")))
            size += len(data)
            if size >= BATCH_BYTES:
                yield batch()
                rows, size = [], 0
        if rows:
            yield batch()


class ContainerLogs(DataSource):
    """``spark.read.format("container_logs").load(path)``; option
    ``rangeBytes`` sets the size of a range."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LogReader:
        return LogReader(dict(self.options))


def read_log_ranges(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``file, offset, length, value`` of every section below ``path``."""
    spark.dataSource.register(ContainerLogs)
    return spark.read.format(NAME).option("rangeBytes", range_bytes).load(path)


def read_logs_with_offsets(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES,
                           full_node: bool = False) -> DataFrame:
    """``file, offset, length, container_id, node_id, log_type, content``: one
    row per container header and log type, with the place of its section."""
    return section_container_logs(read_log_ranges(spark, path, range_bytes), full_node=full_node,
                                  keep=("file", "offset", "length"))

"""Log segments: SQLite files read in parallel, in batch or as a stream.

A file is read on an executor, a large one in ranges by several tasks, many small
ones by one task. Nothing but paths and sizes passes through the driver. A row whose
statement is empty repeats the one before it, so each range looks up the last
statement in front of it and the fill (C01) needs no shuffle.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from deltaloom.functions.columns import join_same

LOG, TXN, METADATA = "log", "txn", "metadata"

LOG_SCHEMA = (
    "_device_id string, _device_name string, _segment bigint, _seq bigint, _txn_seq bigint, _commit_id bigint,"
    " sql string, args array<binary>, _file string"
)
METADATA_SCHEMA = "_device_id string, _device_name string, _segment bigint, key string, value string, _file string"

# <anything>_<device name>_<device id>/<segment>.sqllog ; '_' or '-' between the parts
DEVICE_DIR = r"(?:^|/)[^/_-]+[_-](?P<name>[A-Za-z0-9]+)[_-](?P<id>[^/]+)/"
FILE_NAMES = {
    LOG: r"(?P<segment>\d+)\.sqllog$",
    TXN: r"(?P<segment>\d+)\.sqllog\.(?P<commit>\d+)\.txn$",
    METADATA: r"(?P<segment>\d+)(?:\.[A-Za-z]+)?\.metadata$",
}
BATCH_ROWS = 10_000


@dataclass
class SegmentRange:
    """Part ``index`` of ``count`` of a segment file."""

    path: str
    device_id: str
    device_name: str
    segment: int
    commit: int | None
    index: int
    count: int
    size: int
    arrived: int


@dataclass
class SegmentPack(InputPartition):
    """Ranges read by one task, one after the other: a large file's, or many small files."""

    parts: list[SegmentRange]


# A task opens files worth about PACK_BYTES; fewer while there are not yet PACKS tasks.
PACK_BYTES, OPEN_COST, PACKS = 64 * 1024 * 1024, 1024 * 1024, 64


def _packed(parts: list[SegmentRange]) -> list[SegmentPack]:
    """Pack small files (published transactions, above all) into fewer tasks."""
    costs = [p.size // p.count + OPEN_COST for p in parts]
    budget = min(PACK_BYTES, max(OPEN_COST, sum(costs) // PACKS))
    packs, room = [], 0
    for part, cost in zip(parts, costs):
        if not packs or room < cost:
            packs.append(SegmentPack([]))
            room = budget
        packs[-1].parts.append(part)
        room -= cost
    return packs or [SegmentPack([])]


def _walk(root: str) -> Iterator[tuple[str, int, int]]:
    """Files below a folder with their sizes and when they came there (ns); other file systems through Arrow."""
    local = root[len("file:"):] if root.startswith("file:") else root
    if "://" not in local:
        local = "/" + local.lstrip("/") if root.startswith("file:") else local
        for folder, _, names in os.walk(local):
            for name in names:
                path = os.path.join(folder, name)
                found = os.stat(path)
                yield path, found.st_size, found.st_ctime_ns  # a file moved into place keeps its time of modification
        return
    from pyarrow import fs

    files, base = fs.FileSystem.from_uri(root)
    scheme = root.split("://", 1)[0]
    for info in files.get_file_info(fs.FileSelector(base, recursive=True)):
        if info.type == fs.FileType.File:
            yield f"{scheme}://{info.path}", info.size, info.mtime_ns or 0


def _segments(options: dict[str, str]) -> list[SegmentRange]:
    kind = options.get("kind", LOG)
    pattern = re.compile(options.get("devicepattern", DEVICE_DIR) + FILE_NAMES[kind])
    split = int(options.get("splitbytes", 256 * 1024 * 1024))
    found = []
    for path, size, arrived in _walk(options["path"]):
        match = pattern.search(path)
        if match is None:
            continue
        named = match.groupdict()
        count = max(1, -(-size // split)) if kind == LOG else 1
        for index in range(count):
            found.append(
                SegmentRange(
                    path,
                    named["id"],
                    named["name"],
                    int(named["segment"]),
                    int(named["commit"]) if named.get("commit") else None,
                    index,
                    count,
                    size,
                    arrived,
                )
            )
    return sorted(found, key=lambda s: (s.segment, s.device_id, s.path, s.index))


class _LocalCopy:
    """The file itself when it is local, else a copy that lives as long as the task."""

    def __init__(self, path: str):
        self.path, self.copy = path, None

    def __enter__(self) -> str:
        if "://" not in self.path:
            return self.path
        import shutil

        from pyarrow import fs

        files, inner = fs.FileSystem.from_uri(self.path)
        handle, self.copy = tempfile.mkstemp(suffix=".sqllog")
        with os.fdopen(handle, "wb") as out, files.open_input_stream(inner) as source:
            shutil.copyfileobj(source, out, 1 << 20)
        return self.copy

    def __exit__(self, *_):
        if self.copy is not None:
            os.unlink(self.copy)


def _as_bytes(value) -> bytes | None:
    if value is None or isinstance(value, bytes):
        return value
    return (repr(value) if isinstance(value, float) else str(value)).encode("utf-8")


def _read_log(part: SegmentRange, fill: bool):
    import sqlite3

    import pyarrow as pa

    names = ["_device_id", "_device_name", "_segment", "_seq", "_txn_seq", "_commit_id", "sql", "args", "_file"]
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.binary()), pa.string()]
    schema = pa.schema(list(zip(names, types)))
    with _LocalCopy(part.path) as path:
        conn = sqlite3.connect(f"file:{path}?mode=ro&immutable=1", uri=True)
        try:
            low, high = conn.execute(
                "SELECT min(change_sequence_number), max(change_sequence_number) FROM commandlog"
            ).fetchone()
            if low is None:
                return
            width = -(-(high - low + 1) // part.count)
            low, high = low + part.index * width, min(high, low + (part.index + 1) * width - 1)
            statement = None
            if fill and part.index > 0:
                before = conn.execute(
                    "SELECT sql FROM commandlog WHERE change_sequence_number < ? AND sql <> ''"
                    " ORDER BY change_sequence_number DESC LIMIT 1",
                    (low,),
                ).fetchone()
                statement = before[0] if before else None
            columns = [r[1] for r in conn.execute("PRAGMA table_info(commandlog)")]
            args = sorted((c for c in columns if re.fullmatch(r"arg\d+", c)), key=lambda c: int(c[3:]))
            rows = conn.execute(
                f"SELECT change_sequence_number, commit_id, sql, argcnt{''.join(', ' + a for a in args)} FROM commandlog"
                " WHERE change_sequence_number BETWEEN ? AND ? ORDER BY change_sequence_number",
                (low, high),
            )
            while batch := rows.fetchmany(BATCH_ROWS):
                texts = []
                for row in batch:
                    if row[2]:
                        statement = row[2]
                    texts.append(statement if fill else row[2])
                n = len(batch)
                values = [[_as_bytes(v) for v in row[4 : 4 + (row[3] or 0)]] for row in batch]
                # arguments beyond the stored columns read as null
                values = [v + [None] * ((row[3] or 0) - len(v)) for v, row in zip(values, batch)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.device_id] * n, types[0]),
                        pa.array([part.device_name] * n, types[1]),
                        pa.array([part.segment] * n, types[2]),
                        pa.array([row[0] for row in batch], types[3]),
                        pa.array([0] * n, types[4]),
                        pa.array([part.commit if part.commit is not None else row[1] for row in batch], types[5]),
                        pa.array(texts, types[6]),
                        pa.array(values, types[7]),
                        pa.array([part.path] * n, types[8]),
                    ],
                    schema=schema,
                )
        finally:
            conn.close()


def _read_metadata(part: SegmentRange):
    import sqlite3

    with _LocalCopy(part.path) as path:
        conn = sqlite3.connect(f"file:{path}?mode=ro&immutable=1", uri=True)
        try:
            for key, value in conn.execute("SELECT key, value FROM metadata"):
                yield (part.device_id, part.device_name, part.segment, key, None if value is None else str(value), part.path)
        finally:
            conn.close()


class SegmentReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self):
        return _packed(_segments(self.options))

    def read(self, partition: SegmentPack):
        fill = self.options.get("fill", "true").lower() == "true"
        for part in partition.parts:
            yield from _read_metadata(part) if self.options.get("kind", LOG) == METADATA else _read_log(part, fill)


class SegmentStreamReader(DataSourceStreamReader):
    """Offsets are the last segment per device; a missing segment holds its device back.

    Devices begin with segment ``firstSegment`` (0): a late first segment is waited
    for like any other. Files read by a running stream may be removed; before a
    restart the files from the first segment on must be there.
    """

    def __init__(self, options: dict[str, str]):
        self.options = options
        self.reached: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {"devices": "{}"}

    def latestOffset(self) -> dict:
        numbers: dict[str, set[int]] = {}
        for part in _segments(self.options):
            numbers.setdefault(part.device_id, set()).add(part.segment)
        first, reached = int(self.options.get("firstsegment", 0)), {}
        for device, found in numbers.items():
            last = self.reached.get(device, first - 1)
            while last + 1 in found:
                last += 1
            if last >= first:
                reached[device] = last
        self.reached |= reached
        return {"devices": json.dumps(reached, sort_keys=True)}

    def partitions(self, start: dict, end: dict):
        done, until = json.loads(start["devices"]), json.loads(end["devices"])
        self.reached |= {d: max(n, self.reached.get(d, n)) for d, n in (done | until).items()}
        return _packed(
            [p for p in _segments(self.options) if done.get(p.device_id, -1) < p.segment <= until.get(p.device_id, -1)]
        )

    def read(self, partition: SegmentPack):
        return SegmentReader(self.options).read(partition)

    def commit(self, end: dict) -> None:
        pass


class TransactionStreamReader(DataSourceStreamReader):
    """Transaction files in the order in which they come: one file may come long after its segment.

    An offset is the time of arrival reached, with the files that came at that very moment.
    """

    def __init__(self, options: dict[str, str]):
        self.options = options

    def initialOffset(self) -> dict:
        return {"arrived": 0, "files": "[]"}

    def latestOffset(self) -> dict:
        found = _segments(self.options)
        last = max((p.arrived for p in found), default=0)
        return {"arrived": last, "files": json.dumps(sorted(p.path for p in found if p.arrived == last))}

    def partitions(self, start: dict, end: dict):
        def seen(offset: dict):
            at, files = offset["arrived"], set(json.loads(offset["files"]))
            return lambda p: p.arrived < at or (p.arrived == at and p.path in files)

        before, until = seen(start), seen(end)
        return _packed([p for p in _segments(self.options) if until(p) and not before(p)])

    def read(self, partition: SegmentPack):
        return SegmentReader(self.options).read(partition)

    def commit(self, end: dict) -> None:
        pass


class SegmentSource(DataSource):
    """``spark.read.format("logsegments")``: options path, kind, devicePattern, fill, splitBytes."""

    @classmethod
    def name(cls) -> str:
        return "logsegments"

    def _plain(self) -> dict[str, str]:
        return {k.lower(): v for k, v in self.options.items()}

    def schema(self) -> str:
        return METADATA_SCHEMA if self._plain().get("kind", LOG) == METADATA else LOG_SCHEMA

    def reader(self, schema) -> SegmentReader:
        return SegmentReader(self._plain())

    def streamReader(self, schema) -> DataSourceStreamReader:
        options = self._plain()
        return (TransactionStreamReader if options.get("kind", LOG) == TXN else SegmentStreamReader)(options)


def _reader(spark: SparkSession, path: str, streaming: bool, **options):
    spark.dataSource.register(SegmentSource)
    reader = (spark.readStream if streaming else spark.read).format("logsegments").option("path", path)
    for name, value in options.items():
        if value is not None:
            reader = reader.option(name, value)
    return reader.load()


def scan_log(spark: SparkSession, path: str, device_pattern: str | None = None, fill: bool = True, streaming: bool = False, split_bytes: int | None = None, first_segment: int | None = None) -> DataFrame:
    """Command-log rows of all segments of all devices below a folder."""
    return _reader(spark, path, streaming, kind=LOG, devicePattern=device_pattern, fill=str(fill), splitBytes=split_bytes, firstSegment=first_segment)


def scan_transactions(spark: SparkSession, path: str, device_pattern: str | None = None, streaming: bool = False) -> DataFrame:
    """Rows of per-commit files; the commit id comes from the file name. As a stream, files in the order of their arrival."""
    return _reader(spark, path, streaming, kind=TXN, devicePattern=device_pattern)


def scan_metadata(spark: SparkSession, path: str, device_pattern: str | None = None) -> DataFrame:
    return _reader(spark, path, False, kind=METADATA, devicePattern=device_pattern)


# Metadata keys of a segment
METADATA_KEYS = ["uuid", "device-name", "database-name", "log-segment-sequence-number", "status"]


def segment_metadata(rows: DataFrame) -> DataFrame:
    """One row per segment, metadata keys as columns."""
    return rows.groupBy("_device_id", "_device_name", "_segment").pivot("key", METADATA_KEYS).agg(F.first("value"))


def ready_segments(log: DataFrame, metadata: DataFrame) -> DataFrame:
    """Rows of segments that are not applied yet (segments without metadata are ready)."""
    applied = metadata.where(F.col("status") == "APPLIED").select("_device_id", "_segment")
    return join_same(log, applied, ["_device_id", "_segment"], "left_anti").select(*log.columns)


def device_of(path_column: str = "_file", pattern: str = DEVICE_DIR):
    """S09 for frames that carry a file path: device id and name expressions."""
    plain = re.sub(r"\?P<\w+>", "", pattern)
    path = F.col(path_column)
    return F.regexp_extract(path, plain, 2).alias("_device_id"), F.regexp_extract(path, plain, 1).alias("_device_name")

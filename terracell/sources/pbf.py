"""Source of raw entities in PBF files, as a Python data source named ``pbf``.

A file is a row of blobs, each behind a header with its size. Planning reads the headers only
and seeks past the blobs; runs of blobs of about ``split_bytes`` become partitions, which open
the file at their offset. Paths are those that pyarrow's file systems can open, so executors
need no copy of their own. A block's number is its place among the data blobs of all files in
order of path, which does not depend on how the blobs are dealt.

A blob that cannot be decoded fails its task, unless option ``skip_broken`` is ``true``: then it
gives no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = (
    "block_id long, entity string, id long, ts_millis long, lat double, lon double, entries array<struct<k:string,v:string>>, "
    "node_ids array<long>, lats array<double>, lons array<double>, members array<struct<member_id:bigint,member_type:string,member_role:string>>"
)
SPLIT_BYTES = 64 << 20
KINDS = "NWR"  # fixed values: member types 0, 1, 2
DATA = b"OSMData"  # fixed value: the type of blobs that hold entities


# --- wire format ---------------------------------------------------------------------------
def varint(buf: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = buf[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def fields(buf: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message's fields: integers as unsigned, all else as bytes."""
    at = 0
    while at < len(buf):
        tag, at = varint(buf, at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(buf, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if kind == 2:
                size, at = varint(buf, at)
            if size is None or at + size > len(buf):
                raise ValueError("malformed message")
            value, at = buf[at : at + size], at + size
        yield tag >> 3, value


def packed(buf: bytes) -> list[int]:
    out, at = [], 0
    while at < len(buf):
        value, at = varint(buf, at)
        out.append(value)
    return out


def signed(value: int) -> int:
    """A 64-bit two's complement integer."""
    return value - (1 << 64) if value >> 63 else value


def zigzag(value: int) -> int:
    return (value >> 1) ^ -(value & 1)


def running(values: list[int]) -> list[int]:
    """Running sums of zigzag differences."""
    out, total = [], 0
    for v in values:
        total += zigzag(v)
        out.append(total)
    return out


# --- blobs ---------------------------------------------------------------------------------
@dataclass(frozen=True)
class Blob:
    path: str
    offset: int
    size: int
    block_id: int


def blobs(path: str, first: int = 0) -> list[Blob]:
    """The data blobs of a file, by its headers."""
    at, out = 0, []
    system, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    with system.open_input_file(inner) as file:
        end = file.size()
        while at < end:
            head = file.read_at(4, at)
            if len(head) < 4:
                raise ValueError(f"{path}: cut off at {at}")
            (n,) = struct.unpack(">I", head)
            found = dict(fields(file.read_at(n, at + 4)))
            at += 4 + n
            size = found[3]
            if at + size > end:
                raise ValueError(f"{path}: cut off at {at}")
            if found[1] == DATA:
                out.append(Blob(path, at, size, first + len(out)))
            at += size
    return out


def payload(blob: bytes) -> bytes:
    found = dict(fields(blob))
    if 1 in found:
        return found[1]
    if 3 in found:
        return zlib.decompress(found[3])
    if 7 in found:
        import zstandard

        return zstandard.ZstdDecompressor().decompress(found[7], max_output_size=found.get(2, 0))
    raise ValueError(f"compression of fields {sorted(found)} is not supported")


def decoded(block_id: int, data: bytes) -> Iterator[tuple]:
    """Rows of SCHEMA for a block, in its order."""
    strings: list[str] = []
    groups, scale = [], {17: 100, 18: 1000, 19: 0, 20: 0}
    for number, value in fields(data):
        if number == 1:
            strings = [v.decode("utf-8", "replace") for k, v in fields(value) if k == 1]
        elif number == 2:
            groups.append(value)
        elif number in scale:
            scale[number] = signed(value)
    degrees = lambda v, axis: (scale[axis] + scale[17] * v) / 1e9

    def common(found: dict) -> tuple[int | None, list[tuple[str, str]]]:
        info = dict(fields(found.get(4, b"")))
        entries = [(strings[k], strings[v]) for k, v in zip(packed(found.get(2, b"")), packed(found.get(3, b"")), strict=True)]
        return (signed(info[2]) * scale[18] if 2 in info else None), entries

    def dense(found: dict) -> Iterator[tuple]:
        ids, lats, lons = (running(packed(found.get(k, b""))) for k in (1, 8, 9))
        info = dict(fields(found.get(5, b"")))
        times = [t * scale[18] for t in running(packed(info[2]))] if 2 in info else [None] * len(ids)
        flat, at = packed(found.get(10, b"")), 0
        for i, t, lat, lon in zip(ids, times, lats, lons, strict=True):
            entries = []
            while at < len(flat) and flat[at]:
                entries.append((strings[flat[at]], strings[flat[at + 1]]))
                at += 2
            at += 1
            yield block_id, "N", i, t, degrees(lat, 19), degrees(lon, 20), entries, None, None, None, None

    for group in groups:
        for number, value in fields(group):
            if number not in (1, 2, 3, 4):
                continue
            found = dict(fields(value))
            if number == 2:
                yield from dense(found)
                continue
            t, entries = common(found)
            if number == 1:
                yield block_id, "N", zigzag(found[1]), t, degrees(zigzag(found[8]), 19), degrees(zigzag(found[9]), 20), entries, None, None, None, None
            elif number == 3:
                lats, lons = ([degrees(v, axis) for v in running(packed(found[k]))] if k in found else None for k, axis in ((9, 19), (10, 20)))
                yield block_id, "W", signed(found[1]), t, None, None, entries, running(packed(found.get(8, b""))), lats, lons, None
            else:
                roles, ids, kinds = (packed(found.get(k, b"")) for k in (8, 9, 10))
                members = [(i, KINDS[k], strings[r]) for i, k, r in zip(running(ids), kinds, roles, strict=True)]
                yield block_id, "R", signed(found[1]), t, None, None, entries, None, None, None, members


# --- data source ---------------------------------------------------------------------------
@dataclass
class Run(InputPartition):
    blobs: list[Blob]


class PbfReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p for p in options.get("path", "").split(",") if p]
        if not self.paths:
            raise ValueError("pbf: no path")
        self.split, self.skip = int(options.get("split_bytes", SPLIT_BYTES)), str(options.get("skip_broken", "false")).lower() == "true"

    def partitions(self) -> list[Run]:
        out, n = [], 0
        for path in sorted(self.paths):
            held = 0
            for blob in (found := blobs(path, n)):
                if not held or held + blob.size > self.split:
                    out.append(Run([]))
                    held = 0
                out[-1].blobs.append(blob)
                held += blob.size
            n += len(found)
        return out or [Run([])]

    def read(self, partition: Run) -> Iterator[tuple]:
        for blob in partition.blobs:
            system, inner = fs.FileSystem.from_uri(blob.path) if "://" in blob.path else (fs.LocalFileSystem(), blob.path.removeprefix("file:"))
            with system.open_input_file(inner) as file:
                data = file.read_at(blob.size, blob.offset)
            try:
                rows = list(decoded(blob.block_id, payload(data)))  # one block: some thousands of entities
            except (ValueError, KeyError, IndexError, zlib.error) as e:
                if not self.skip:
                    raise ValueError(f"{blob.path}: block at {blob.offset} cannot be decoded: {e!r}") from e
                continue
            yield from rows


class PbfSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pbf"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PbfReader:
        return PbfReader(self.options)


def read(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """All entities of the file (or files, by commas), as rows of SCHEMA."""
    spark.dataSource.register(PbfSource)
    return spark.read.format("pbf").options(**options).load(path)


def nodes(entities: DataFrame) -> DataFrame:
    return entities.where("entity = 'N'").select("block_id", "id", "ts_millis", "lat", "lon", "entries")


def ways(entities: DataFrame) -> DataFrame:
    return entities.where("entity = 'W'").select("block_id", "id", "ts_millis", "node_ids", "lats", "lons", "entries")


def relations(entities: DataFrame) -> DataFrame:
    return entities.where("entity = 'R'").select("block_id", "id", "entries", "members")


def retained(nodes_: DataFrame, relations_: DataFrame) -> DataFrame:
    """Nodes that carry tags or are members of a relation."""
    member = relations_.select(F.explode("members").alias("m")).where("m.member_type = 'N'").select(F.col("m.member_id").alias("id")).distinct()
    tagged = F.size("entries") > 0
    return nodes_.where(tagged).unionByName(nodes_.where(~tagged).join(member, "id", "left_semi"))

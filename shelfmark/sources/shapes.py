"""Polygon files (main file, index and attribute table) as a data source of Spark, and a writer of them.

A file's index holds 8 bytes for each record, so partitions are ranges of records, and a task reads the index, the polygons
and the attributes of its range only. Rings of holes and of several parts are kept as they lie in the record.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .stores import listed, opened, put

#: Fixed values of the format: the file's code, its version, and the codes of polygons (plain, with heights, with measures).
FILE_CODE, VERSION, POLYGON, NULL_SHAPE = 9994, 1000, 5, 0
POLYGONS = (5, 15, 25)
HEADER = 100
RINGS = "array<array<struct<x: double, y: double>>>"
#: Records that a task reads.
RECORDS = 5_000


@dataclass
class Attribute:
    name: str
    kind: str
    width: int


@dataclass
class _Range(InputPartition):
    path: str
    first: int
    end: int


def _table_header(path: str) -> tuple[int, int, int, list[Attribute]]:
    """Records, the header's and a record's length, and the attributes of an attribute table."""
    with opened(path) as f:
        records, header, length = struct.unpack("<4xIHH", f.read(12))
        f.seek(32)
        fields = f.read(header - 32)
    out = []
    for at in range(0, len(fields) - 31, 32):
        if fields[at] == 0x0D:
            break
        name, kind, width = struct.unpack_from("<11sc4xB", fields, at)
        out.append(Attribute(name.split(b"\0")[0].decode("ascii").lower(), kind.decode("ascii"), width))
    return records, header, length, out


def _value(raw: bytes, kind: str):
    text = raw.decode("utf-8", "replace").strip(" \0")
    if not text:
        return None
    if kind in "NF":
        return float(text) if set(text) - set("*") else None
    return text


def rings_of(record: bytes) -> list[np.ndarray] | None:
    """Rings of a polygon's content, each an array of points; None for an empty shape."""
    (kind,) = struct.unpack_from("<i", record)
    if kind == NULL_SHAPE:
        return None
    if kind not in POLYGONS:
        raise ValueError(f"records of kind {kind} are not polygons")
    parts, points = struct.unpack_from("<ii", record, 36)
    starts = np.frombuffer(record, "<i4", parts, 44)
    xy = np.frombuffer(record, "<f8", 2 * points, 44 + 4 * parts).reshape(-1, 2)
    return [xy[a:b] for a, b in zip(starts, [*starts[1:], points])]


class PolygonSource(DataSource):
    """spark.read.format("polygons").load(folder or file): rings, and a column for each attribute."""

    @classmethod
    def name(cls) -> str:
        return "polygons"

    def _files(self) -> list[str]:
        path = self.options["path"]
        return [path] if path.endswith(".shp") else listed(path, ".shp")

    def schema(self) -> str:
        files = self._files()
        if not files:
            raise FileNotFoundError(f"no polygon files in {self.options['path']}")
        fields = _table_header(files[0][:-4] + ".dbf")[3]
        return ", ".join([f"rings {RINGS}", *[f"`{a.name}` {'double' if a.kind in 'NF' else 'string'}" for a in fields]])

    def reader(self, schema) -> DataSourceReader:
        return _PolygonReader(self._files(), [f.name for f in schema.fields], int(self.options.get("records", RECORDS)))


class _PolygonReader(DataSourceReader):
    def __init__(self, files: list[str], columns: list[str], records: int):
        self.files, self.columns, self.records = files, columns, records

    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        for path in self.files:
            with opened(path[:-4] + ".shx") as index:
                n = (index.size() - HEADER) // 8
            out += [_Range(path, at, min(n, at + self.records)) for at in range(0, n, self.records)]
        return out

    def read(self, partition: _Range) -> Iterator[tuple]:
        first, end = partition.first, partition.end
        with opened(partition.path[:-4] + ".shx") as f:
            f.seek(HEADER + 8 * first)
            index = np.frombuffer(f.read(8 * (end - first)), ">i4").reshape(-1, 2).astype(np.int64) * 2  # in words of two bytes
        with opened(partition.path) as f:
            low = int(index[:, 0].min())
            f.seek(low)
            shapes = f.read(int((index[:, 0] + index[:, 1]).max()) + 8 - low)
        table = partition.path[:-4] + ".dbf"
        _, header, length, fields = _table_header(table)
        with opened(table) as f:
            f.seek(header + length * first)
            rows = f.read(length * (end - first))
        for k, (offset, size) in enumerate(index.tolist()):
            at, values = length * k + 1, {}
            for a in fields:
                values[a.name] = _value(rows[at : at + a.width], a.kind)
                at += a.width
            rings = rings_of(shapes[offset - low + 8 : offset - low + 8 + size])
            values["rings"] = None if rings is None else [[(float(x), float(y)) for x, y in ring] for ring in rings]
            yield tuple(values[c] for c in self.columns)


def read_polygons(spark: SparkSession, path: str, records: int = RECORDS) -> DataFrame:
    spark.dataSource.register(PolygonSource)
    return spark.read.format("polygons").option("records", records).load(path)


def _content(rings: list[np.ndarray] | None) -> bytes:
    if not rings:
        return struct.pack("<i", NULL_SHAPE)
    every = np.concatenate(rings)
    starts = np.cumsum([0, *[len(r) for r in rings[:-1]]])
    box = (*every.min(axis=0), *every.max(axis=0))
    return struct.pack("<i4dii", POLYGON, *box, len(rings), len(every)) + starts.astype("<i4").tobytes() + every.astype("<f8").tobytes()


def _file(words: int, box: tuple) -> bytes:
    return struct.pack(">i5ii", FILE_CODE, 0, 0, 0, 0, 0, words) + struct.pack("<ii8d", VERSION, POLYGON, *box, 0.0, 0.0, 0.0, 0.0)


def polygon_files(shapes: list[list[np.ndarray] | None], rows: list[tuple], fields: list[Attribute]) -> tuple[bytes, bytes, bytes]:
    """Main file, index and attribute table of some polygons."""
    body, index, at = [], [], HEADER
    for number, rings in enumerate(shapes, 1):
        content = _content(rings)
        body.append(struct.pack(">ii", number, len(content) // 2) + content)
        index.append(struct.pack(">ii", at // 2, len(content) // 2))
        at += 8 + len(content)
    points = [p for rings in shapes if rings for p in rings]
    every = np.concatenate(points) if points else np.zeros((1, 2))
    box = (*every.min(axis=0), *every.max(axis=0))
    table = struct.pack("<BBBBIHH20x", 3, 124, 1, 1, len(rows), 33 + 32 * len(fields), 1 + sum(a.width for a in fields))
    table += b"".join(struct.pack("<11sc4xBB14x", a.name.encode("ascii")[:10], a.kind.encode("ascii"), a.width, 0) for a in fields) + b"\x0d"
    for row in rows:
        table += b" "
        for value, a in zip(row, fields):
            text = ("" if value is None else str(value)).encode("utf-8")
            if len(text) > a.width:
                raise ValueError(f"{a.name} is wider than {a.width}: {value}")
            table += text.rjust(a.width) if a.kind == "N" else text.ljust(a.width)
    return _file(at // 2, box) + b"".join(body), _file(HEADER // 2 + 4 * len(shapes), box) + b"".join(index), table + b"\x1a"


def write_polygons(df: DataFrame, path: str, fields: dict[str, tuple[str, int]], rings: str = "rings") -> int:
    """Files of polygons in a folder, one set a task, each named by the task's number so that a task that runs again
    replaces its own. fields: column -> kind (C text, N number) and width. Gives the number of records."""
    columns = [Attribute(n, k, w) for n, (k, w) in fields.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        shapes, rows = [], []
        for batch in batches:
            for r, *values in zip(*[c.to_pylist() for c in batch.columns]):
                shapes.append(None if r is None else [np.array([(p["x"], p["y"]) for p in ring]) for ring in r])
                rows.append(tuple(values))
        if shapes:
            for suffix, data in zip(("dbf", "shx", "shp"), reversed(polygon_files(shapes, rows, columns))):
                put(f"{path}/{number:05d}.{suffix}", data)
        yield pa.RecordBatch.from_pydict({"n": pa.array([len(shapes)], pa.int64())})

    picked = df.select(F.col(rings).alias("rings"), *fields)
    return picked.mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0

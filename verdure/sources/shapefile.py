"""Shapefiles as a Spark data source, read and written: shapes by runs of records through the index file, attributes by their fixed place.

Rows are (path, record, kind, properties, rings): points, lines and polygons have a ring for each part, of polygons outer ones run clockwise and holes counterclockwise; heights and measures are
left out. A null shape has null rings, a deleted attribute record no row. A partition is a run of records of about ``block_mb``; ``box`` (x0, y0, x1, y1) leaves out shapes whose own box
lies outside, before their points are decoded. Without attribute file the properties are empty.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from verdure.functions.overlay import _signed

from .geotiff import file_system, files_of

SCHEMA = "path string, record int, kind int, properties map<string,string>, rings array<array<struct<x:double,y:double>>>"
POINTS = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))

#: Fixed values of the format: file code and version, kinds of shapes (with measures 20 more, with heights 10 more), the longest text and name of an attribute.
CODE, VERSION = 9994, 1000
POINT, LINE, POLYGON, POINT_SET = 1, 3, 5, 8
WIDEST, NAME = 254, 10


@dataclass(frozen=True)
class Fields:
    """Where the attribute file keeps its records."""

    names: tuple[str, ...]
    widths: tuple[int, ...]
    start: int
    length: int


@dataclass
class Run(InputPartition):
    """Records ``first`` to ``last`` of a file and the bytes that hold their shapes."""

    path: str
    first: int
    last: int
    begin: int
    end: int
    fields: Fields | None


def parse_fields(head: bytes) -> Fields:
    start, length = struct.unpack("<HH", head[8:12])
    names, widths, at = [], [], 32
    while at + 32 <= len(head) and head[at] != 0x0D:
        names.append(head[at : at + 11].split(b"\0")[0].decode("latin-1"))
        widths.append(head[at + 16])
        at += 32
    return Fields(tuple(names), tuple(widths), start, length)


def parse_shape(data: bytes, box: tuple[float, ...] | None) -> tuple[int, list | None] | None:
    """(kind, rings) of a record's content; None if it lies outside ``box``."""
    kind = struct.unpack("<i", data[:4])[0]
    if not kind:
        return None if box else (0, None)
    plain = kind % 10
    if plain == POINT:
        xy = np.frombuffer(data, "<f8", 2, 4).reshape(1, 2)
        own, starts = (*xy[0], *xy[0]), [0]
    else:
        own = struct.unpack("<4d", data[4:36])
        if plain == POINT_SET:
            starts, n, at = [0], struct.unpack("<i", data[36:40])[0], 40
        elif plain in (LINE, POLYGON):
            parts, n = struct.unpack("<2i", data[36:44])
            starts, at = list(struct.unpack(f"<{parts}i", data[44 : 44 + 4 * parts])), 44 + 4 * parts
        else:
            raise ValueError(f"shapes of kind {kind} aren't read")
        xy = None
    if box and (own[0] > box[2] or own[2] < box[0] or own[1] > box[3] or own[3] < box[1]):
        return None
    if xy is None:
        xy = np.frombuffer(data, "<f8", 2 * n, at).reshape(n, 2)
    rings = []
    for a, b in zip(starts, [*starts[1:], len(xy)]):
        r = xy[a:b]
        if plain == POLYGON and len(r) > 1 and (r[0] == r[-1]).all():
            r = r[:-1]
        rings.append([{"x": x, "y": y} for x, y in r.tolist()])
    return plain, rings


class ShapefileReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.encoding = options["path"], options.get("encoding", "utf-8")
        self.block = float(options.get("block_mb", "32")) * 1e6
        self.box = tuple(float(v) for v in options["box"].split(",")) if options.get("box") else None

    def partitions(self) -> list[Run]:
        out = []
        for path in files_of(self.path, (".shp",)):
            store, inner = file_system(path)
            with store.open_input_file(inner[:-3] + "shx") as f:
                index = np.frombuffer(f.read()[100:], ">i4").reshape(-1, 2).astype(np.int64) * 2
            fields = None
            if store.get_file_info(inner[:-3] + "dbf").type.name == "File":
                with store.open_input_file(inner[:-3] + "dbf") as f:
                    fields = parse_fields(f.read_at(struct.unpack("<H", f.read_at(2, 8))[0], 0))
            ends = index[:, 0] + index[:, 1] + 8
            first = 0
            while first < len(index):
                # records follow each other as a rule; a run ends where they don't, or where it has enough bytes
                steps = np.flatnonzero((index[first + 1 :, 0] < ends[first:-1]) | (ends[first + 1 :] - index[first, 0] > self.block))
                last = first + 1 + int(steps[0]) if len(steps) else len(index)
                out.append(Run(path, first, last, int(index[first, 0]), int(ends[last - 1]), fields))
                first = last
        return out or [Run("", 0, 0, 0, 0, None)]

    def read(self, part: Run) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        store, inner = file_system(part.path)
        with store.open_input_file(inner[:-3] + "shx") as f:
            index = np.frombuffer(f.read_at(8 * (part.last - part.first), 100 + 8 * part.first), ">i4").reshape(-1, 2).astype(np.int64) * 2
        with store.open_input_file(inner) as f:
            shapes = f.read_at(part.end - part.begin, part.begin)
        table = b""
        if part.fields:
            with store.open_input_file(inner[:-3] + "dbf") as f:
                table = f.read_at(part.fields.length * (part.last - part.first), part.fields.start + part.fields.length * part.first)
        rows: list[tuple] = []
        for i, (at, length) in enumerate(index.tolist()):
            properties = []
            if part.fields:
                row = table[i * part.fields.length : (i + 1) * part.fields.length]
                if row[:1] == b"*":
                    continue
                place = 1
                for name, width in zip(part.fields.names, part.fields.widths):
                    properties.append((name, row[place : place + width].decode(self.encoding, "replace").strip(" \0") or None))
                    place += width
            begin = at - part.begin + 8
            shape = parse_shape(shapes[begin : begin + length], self.box)
            if shape is not None:
                rows.append((part.first + i, shape[0], properties, shape[1]))
            if len(rows) == 1000:
                yield self._batch(part.path, rows)
                rows = []
        if rows:
            yield self._batch(part.path, rows)

    @staticmethod
    def _batch(path: str, rows: list[tuple]) -> pa.RecordBatch:
        record, kind, properties, rings = zip(*rows)
        cols = [pa.array([path] * len(rows), pa.string()), pa.array(record, pa.int32()), pa.array(kind, pa.int32()), pa.array(properties, pa.map_(pa.string(), pa.string())), pa.array(rings, POINTS)]
        return pa.RecordBatch.from_arrays(cols, names=["path", "record", "kind", "properties", "rings"])


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class ShapefileWriter(DataSourceArrowWriter):
    """Polygons of (properties, rings), every task its own files, a new one after ``file_mb`` of shapes; they get their names at commit."""

    def __init__(self, options: dict[str, str]):
        self.path, self.limit = options["path"].rstrip("/"), float(options.get("file_mb", "64")) * 1e6
        self.names = options["names"].split(",")
        cut = [n.encode("latin-1", "replace")[:NAME] for n in self.names]
        if len(set(cut)) < len(cut):
            raise ValueError(f"names of attributes must differ in their first {NAME} letters")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        store, folder = file_system(self.path)
        store.create_dir(folder, recursive=True)
        done: list[tuple[str, str]] = []
        shapes: list[tuple[bytes, tuple | None]] = []
        rows: list[list[bytes]] = []
        size = 0
        try:
            for b in batches:
                properties, rings = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("properties", "rings"))
                for p, r in zip(properties, rings):
                    values = dict(p or [])
                    rows.append([("" if values.get(n) is None else values[n]).encode() for n in self.names])
                    if any(len(v) > WIDEST for v in rows[-1]):
                        raise ValueError(f"an attribute has over {WIDEST} bytes")
                    shapes.append(_polygon(r))
                    size += len(shapes[-1][0])
                    if size > self.limit:
                        self._close(store, folder, shapes, rows, done)
                        shapes, rows, size = [], [], 0
            if shapes:
                self._close(store, folder, shapes, rows, done)
            return Written(done)
        except BaseException:
            for temporary, _ in done:
                store.delete_file(temporary)
            raise

    def _close(self, store, folder: str, shapes: list, rows: list, done: list) -> None:
        boxes = np.array([b for _, b in shapes if b]) if any(b for _, b in shapes) else np.zeros((1, 4))
        bounds = (*boxes[:, :2].min(axis=0), *boxes[:, 2:].max(axis=0))
        head = lambda n: struct.pack(">i20xi", CODE, n // 2) + struct.pack("<2i4d32x", VERSION, POLYGON, *bounds)
        body, index, at = [], [], 100
        for i, (content, _) in enumerate(shapes, start=1):
            body.append(struct.pack(">2i", i, len(content) // 2) + content)
            index.append(struct.pack(">2i", at // 2, len(content) // 2))
            at += len(body[-1])
        widths = [max(1, *(len(r[n]) for r in rows)) for n in range(len(self.names))]
        fields = b"".join(n.encode("latin-1", "replace")[:NAME].ljust(11, b"\0") + b"C" + bytes(4) + bytes([w]) + bytes(15) for n, w in zip(self.names, widths))
        table = struct.pack("<4BIHH20x", 3, 100, 1, 1, len(rows), 33 + len(fields), 1 + sum(widths)) + fields + b"\r"
        table += b"".join(b" " + b"".join(v.ljust(w) for v, w in zip(r, widths)) for r in rows) + b"\x1a"
        name = uuid.uuid4().hex
        for ending, data in (("shp", head(at) + b"".join(body)), ("shx", head(100 + 8 * len(index)) + b"".join(index)), ("dbf", table)):
            temporary = f"{folder}/.{name}.{ending}.part"
            done.append((temporary, f"{folder}/part-{name}.{ending}"))
            with store.open_output_stream(temporary) as f:
                f.write(data)

    def commit(self, messages: list[Written | None]) -> None:
        store, _ = file_system(self.path)
        for temporary, name in [f for m in messages if m for f in m.files]:
            store.move(temporary, name)

    def abort(self, messages: list[Written | None]) -> None:
        store, _ = file_system(self.path)
        for temporary, _ in [f for m in messages if m for f in m.files]:
            store.delete_file(temporary)


def _polygon(rings: list | None) -> tuple[bytes, tuple | None]:
    """A record's content and box; rings are closed, the first point once more."""
    if not rings:
        return struct.pack("<i", 0), None
    closed = [np.array([(p["x"], p["y"]) for p in (*r, r[0])]) for r in rings]
    every = np.concatenate(closed)
    box = (*every.min(axis=0).tolist(), *every.max(axis=0).tolist())
    starts = np.cumsum([0] + [len(r) for r in closed[:-1]]).tolist()
    return struct.pack(f"<i4d2i{len(starts)}i", POLYGON, *box, len(starts), len(every), *starts) + every.astype("<f8").tobytes(), box


class Shapefile(DataSource):
    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> ShapefileReader:
        return ShapefileReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> ShapefileWriter:
        return ShapefileWriter(self.options)


def read_shapefile(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """(path, record, kind, properties, rings) of a file or of all in a folder."""
    spark.dataSource.register(Shapefile)
    r = spark.read.format("shapefile")
    return (r.option("box", ",".join(map(repr, map(float, box)))) if box else r).load(path)


def largest_ring(rings: Column) -> Column:
    """The largest outer ring of a polygon's, counterclockwise, as the other readers of regions give it."""
    clockwise = F.transform(F.filter(rings, lambda r: _signed(r) < 0), lambda r: F.struct((-_signed(r)).alias("a"), F.reverse(r).alias("r")))
    return F.array_max(clockwise)["r"]


def write_shapefile(rows: DataFrame, path: str, columns: list[str], ring: str = "ring") -> None:
    """Rows as polygons of one ring with ``columns`` as text attributes, added to a folder; null rings are null shapes, and empty texts are read back as null."""
    rows.sparkSession.dataSource.register(Shapefile)
    pairs = [F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in columns]
    outer = F.when(_signed(F.col(ring)) > 0, F.reverse(F.col(ring))).otherwise(F.col(ring))
    out = rows.select(F.map_from_entries(F.array(*pairs)).alias("properties"), F.when(F.size(ring) > 0, F.array(outer)).alias("rings"))
    out.write.format("shapefile").option("names", ",".join(columns)).mode("append").save(path)

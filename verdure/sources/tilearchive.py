"""Archives of map tiles (PMTiles, version 3) as a Spark data source, read and written.

Writing: coloured pixels in the order of their tile's number; a task encodes one tile at a time as PNG and closes an archive when its tiles fill ``archive_mb``, so it holds that much. An archive is
a range of tile numbers; its name holds the first and the last. Equal tiles are stored once, and of equal neighbours the directory has one entry with a run length. Archives get their names when all
tasks are done, and none of them if one fails.

Reading: rows (path, tile_id, z, tx, ty, data). The plan looks at names only: archives without a number in the range asked for are left out, and the others are a partition each. A task reads the
header, those leaf directories that hold asked numbers, and the bytes of their tiles.

Paths are whatever pyarrow's file systems open. A tile without pixels isn't stored; an empty table writes no archive.
"""

from __future__ import annotations

import gzip
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from verdure.functions import geo
from verdure.sources.geotiff import Written, file_system

SCHEMA = "path string, tile_id long, z int, tx int, ty int, data binary"
#: Fixed values of the format: length of a header, bytes within which the root directory ends, codes for gzip, no compression and PNG.
HEADER, ROOT_END, GZIP, PLAIN, PNG = 127, 16384, 2, 1, 2
#: Entries of a leaf directory.
LEAF = 4096


def varints(numbers: list[int]) -> bytes:
    """Numbers of seven bits a byte, lowest first."""
    out = bytearray()
    for n in numbers:
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        out.append(n)
    return bytes(out)


def numbers(data: bytes) -> list[int]:
    out, now, shift = [], 0, 0
    for b in data:
        now |= (b & 127) << shift
        if b > 127:
            shift += 7
        else:
            out.append(now)
            now = shift = 0
    return out


@dataclass(frozen=True)
class Entry:
    """``run`` tiles from ``first`` on that are the same bytes; with a run of 0 a leaf directory."""

    first: int
    run: int
    size: int
    at: int


def pack_directory(entries: list[Entry]) -> bytes:
    firsts = [e.first for e in entries]
    follows = [False, *(a.at + a.size == b.at for a, b in zip(entries, entries[1:]))]
    columns = [[b - a for a, b in zip([0, *firsts], firsts)], [e.run for e in entries], [e.size for e in entries], [0 if f else e.at + 1 for e, f in zip(entries, follows)]]
    return gzip.compress(varints([len(entries), *(n for c in columns for n in c)]), mtime=0)


def unpack_directory(data: bytes) -> list[Entry]:
    count, *rest = numbers(gzip.decompress(data))
    steps, runs, sizes, places = (rest[i * count : (i + 1) * count] for i in range(4))
    out, first, end = [], 0, 0
    for step, run, size, place in zip(steps, runs, sizes, places):
        first += step
        at = place - 1 if place else end
        end = at + size
        out.append(Entry(first, run, size, at))
    return out


def directories(entries: list[Entry]) -> tuple[bytes, bytes]:
    """The root directory and the leaves; leaves grow until the root has room."""
    root, leaf = pack_directory(entries), LEAF
    if len(root) <= ROOT_END - HEADER:
        return root, b""
    while True:
        leaves, heads = b"", []
        for i in range(0, len(entries), leaf):
            data = pack_directory(entries[i : i + leaf])
            heads.append(Entry(entries[i].first, 0, len(data), len(leaves)))
            leaves += data
        root = pack_directory(heads)
        if len(root) <= ROOT_END - HEADER:
            return root, leaves
        leaf *= 2


def zoom_of(tile: int) -> tuple[int, int, int]:
    """(z, tx, ty) of a tile's number."""
    z = 0
    while tile >= 1 << 2 * z:
        tile -= 1 << 2 * z
        z += 1
    return (z, *geo.cell_at(tile, z))


def encode_png(pixels: np.ndarray) -> bytes:
    """(side, side, 4) bytes of red, green, blue and alpha."""
    h, w, _ = pixels.shape
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    lines = np.zeros((h, 1 + 4 * w), np.uint8)
    lines[:, 1:] = pixels.reshape(h, 4 * w)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 6, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def decode_png(data: bytes) -> np.ndarray:
    """The pixels of an image of four unfiltered channels of a byte, as ``encode_png`` makes them; any other is an error."""
    at, body, shape = 8, b"", (0, 0)
    while at < len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        part = data[at + 8 : at + 8 + size]
        if zlib.crc32(kind + part) != struct.unpack_from(">I", data, at + 8 + size)[0]:
            raise ValueError("damaged image")
        if kind == b"IHDR":
            w, h, depth, colours, *_ = struct.unpack(">IIBBBBB", part)
            if (depth, colours) != (8, 6):
                raise ValueError("only images of red, green, blue and alpha in bytes are read")
            shape = (h, w)
        body += part if kind == b"IDAT" else b""
        at += 12 + size
    lines = np.frombuffer(zlib.decompress(body), np.uint8).reshape(shape[0], 1 + 4 * shape[1])
    if lines[:, 0].any():
        raise ValueError("filtered image lines aren't read")
    return lines[:, 1:].reshape(*shape, 4)


class Archive:
    """One archive in the making: tiles in the order of their numbers."""

    def __init__(self):
        self.entries: list[Entry] = []
        self.body: list[bytes] = []
        self.places: dict[bytes, Entry] = {}
        self.size = self.tiles = 0

    def add(self, tile: int, data: bytes) -> None:
        self.tiles += 1
        known = self.places.get(data)
        if known is None:
            known = self.places[data] = Entry(tile, 1, len(data), self.size)
            self.body.append(data)
            self.size += len(data)
        last = self.entries[-1] if self.entries else None
        if last and last.at == known.at and last.first + last.run == tile:
            self.entries[-1] = Entry(last.first, last.run + 1, last.size, last.at)
        else:
            self.entries.append(Entry(tile, 1, known.size, known.at))

    @property
    def last(self) -> int:
        return self.entries[-1].first + self.entries[-1].run - 1

    def parts(self, about: dict) -> list[bytes]:
        root, leaves = directories(self.entries)
        more = gzip.compress(json.dumps(about).encode(), mtime=0)
        at = [HEADER, HEADER + len(root), HEADER + len(root) + len(more), HEADER + len(root) + len(more) + len(leaves)]
        sections = [x for pair in zip(at, (len(root), len(more), len(leaves), self.size)) for x in pair]
        low, high = zoom_of(self.entries[0].first)[0], zoom_of(self.last)[0]
        world = [-1_800_000_000, -850_511_287, 1_800_000_000, 850_511_287]
        head = struct.pack("<7sB11Q6B4iB2i", b"PMTiles", 3, *sections, self.tiles, len(self.entries), len(self.body), 1, GZIP, PLAIN, PNG, low, high, *world, low, 0, 0)
        return [head, root, more, leaves, *self.body]


class TileWriter(DataSourceArrowWriter):
    """Rows (tile_id, y, x, red, green, blue, alpha) in the order of tile_id, each tile's in one task."""

    def __init__(self, options: dict[str, str]):
        self.path, self.side = options["path"].rstrip("/"), int(options.get("side", "256"))
        self.most, self.about = int(options.get("archive_mb", "256")) << 20, {"name": options.get("title", "tiles")}

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, folder = file_system(self.path)
        store.create_dir(folder, recursive=True)
        done: list[tuple[str, str]] = []
        archive, now, image = Archive(), None, None

        def close() -> None:
            temporary = f"{folder}/.{uuid.uuid4().hex}.part"
            done.append((temporary, f"{folder}/{archive.entries[0].first}-{archive.last}.pmtiles"))
            with store.open_output_stream(temporary) as f:
                for part in archive.parts(self.about):
                    f.write(part)

        try:
            for b in batches:
                ids, y, x, *colours = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("tile_id", "y", "x", "red", "green", "blue", "alpha"))
                if not len(ids):
                    continue
                edges = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
                for a, e in zip(edges, edges[1:]):
                    if ids[a] != now:
                        if now is not None:
                            if ids[a] < now:
                                raise ValueError("tiles out of order")
                            archive.add(now, encode_png(image))
                            if archive.size >= self.most:
                                close()
                                archive = Archive()
                        now, image = int(ids[a]), np.zeros((self.side, self.side, 4), np.uint8)
                    image[y[a:e], x[a:e]] = np.stack([c[a:e] for c in colours], 1)
            if now is not None:
                archive.add(now, encode_png(image))
            if archive.entries:
                close()
            return Written(done)
        except BaseException:
            for temporary, _ in done:
                if store.get_file_info(temporary).type != pafs.FileType.NotFound:
                    store.delete_file(temporary)
            raise

    def commit(self, messages: list[Written | None]) -> None:
        store, _ = file_system(self.path)
        for temporary, name in [f for m in messages if m for f in m.files]:
            store.move(temporary, name)

    def abort(self, messages: list[Written | None]) -> None:
        store, _ = file_system(self.path)
        for temporary, _ in [f for m in messages if m for f in m.files]:
            store.delete_file(temporary)


@dataclass
class OneArchive(InputPartition):
    path: str


class TileReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")
        self.low, self.high = int(options.get("first", "0")), int(options.get("last", str(1 << 62)))

    def partitions(self) -> list[OneArchive]:
        store, folder = file_system(self.path)
        found = sorted(f.path for f in store.get_file_info(pafs.FileSelector(folder, allow_not_found=True)) if f.path.endswith(".pmtiles"))
        ranges = [(p, re.search(r"(\d+)-(\d+)\.pmtiles$", p)) for p in found]
        return [OneArchive(p) for p, m in ranges if not m or (int(m[1]) <= self.high and int(m[2]) >= self.low)]

    def read(self, part: OneArchive | None) -> Iterator[pa.RecordBatch]:
        names = ["path", "tile_id", "z", "tx", "ty", "data"]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        if part is None:  # no archive has an asked number
            return
        store, _ = file_system(self.path)
        with store.open_input_file(part.path) as f:
            head = f.read_at(HEADER, 0)
            if head[:8] != b"PMTiles\x03":
                raise ValueError(f"{part.path} is no archive of version 3")
            root_at, root_size, _, _, leaf_at, _, data_at, _ = struct.unpack_from("<8Q", head, 8)
            if head[97] != GZIP:
                raise ValueError(f"{part.path}: only directories in gzip are read")
            rows, held = [], 0
            for e in self._asked(f, unpack_directory(f.read_at(root_size, root_at)), leaf_at):
                data = f.read_at(e.size, data_at + e.at)
                for tile in range(max(e.first, self.low), min(e.first + e.run - 1, self.high) + 1):
                    rows.append((part.path, tile, *zoom_of(tile), data))
                    held += len(data)
                    if held >= 8 << 20:
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def _asked(self, f, entries: list[Entry], leaf_at: int) -> Iterator[Entry]:
        """The entries with an asked number, leaves opened."""
        for e, after in zip(entries, [*(n.first for n in entries[1:]), 1 << 63]):
            if e.run and e.first <= self.high and e.first + e.run > self.low:
                yield e
            elif not e.run and e.first <= self.high and after > self.low:
                yield from self._asked(f, unpack_directory(f.read_at(e.size, leaf_at + e.at)), leaf_at)


class TileArchive(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tilearchive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> TileReader:
        return TileReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> TileWriter:
        return TileWriter(self.options)


def write_tiles(pixels: DataFrame, path: str, side: int = 256, archive_mb: int = 256, title: str = "tiles") -> None:
    """Archives of coloured pixels (tile_id, y, x, red, green, blue, alpha), an image for each tile: one shuffle by ranges of tile numbers. Of a pixel there may be one row."""
    pixels.sparkSession.dataSource.register(TileArchive)
    rows = pixels.select(F.col("tile_id").cast("long").alias("tile_id"), *(F.col(c).cast("int").alias(c) for c in ("y", "x", "red", "green", "blue", "alpha")))
    w = rows.repartitionByRange("tile_id").sortWithinPartitions("tile_id").write.format("tilearchive").mode("append")
    w.option("side", str(side)).option("archive_mb", str(archive_mb)).option("title", title).save(path)


def read_tiles(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """(path, tile_id, z, tx, ty, data): the tiles of all archives in a folder, or those with numbers from ``first`` to ``last``."""
    spark.dataSource.register(TileArchive)
    r = spark.read.format("tilearchive")
    r = r if first is None else r.option("first", str(first))
    return (r if last is None else r.option("last", str(last))).load(path)


def tile_pixels(tiles: DataFrame) -> DataFrame:
    """(z, tx, ty, tile_id, y, x, red, green, blue, alpha): the pixels of the tiles' images, without those that were never set."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for z, tx, ty, tile, data in zip(*(b.column(n).to_pylist() for n in range(5))):
                image = decode_png(data)
                y, x = np.nonzero(image.any(axis=2))
                values = image[y, x].astype(np.int32)
                same = [np.full(len(y), v, k) for v, k in ((z, np.int32), (tx, np.int32), (ty, np.int32), (tile, np.int64))]
                yield pa.record_batch([pa.array(c) for c in [*same, y.astype(np.int32), x.astype(np.int32), *values.T.copy()]], ["z", "tx", "ty", "tile_id", "y", "x", "red", "green", "blue", "alpha"])

    return tiles.select("z", "tx", "ty", "tile_id", "data").mapInArrow(unpack, "z int, tx int, ty int, tile_id long, y int, x int, red int, green int, blue int, alpha int")

"""GeoTIFF files as a Spark data source, read and written.

Reading: the plan reads the files' headers only (image file directory, place of each strip or tile, georeference); a partition is a group of blocks of one file, of about ``block_mb`` decoded, and
blocks outside ``window`` are never read. Rows are (path, band, y, x, value), pixels without data are left out. Writing: rows (file, band, y, x, value) to a file for each name, in tiles of
512 x 512, deflated, with horizontal differences and a no-data value; files get their names when all tasks are done, and none of them if one fails.

Paths are whatever pyarrow's file systems open (local, hdfs, object stores); executors read ranges of them.

    spark.dataSource.register(GeoTiff)
    spark.read.format("geotiff").option("bands", "1").option("window", "0,0,512,512").load(path)
"""

from __future__ import annotations

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

SCHEMA = "path string, band int, y int, x int, value double"
#: Fixed values of the format: tags, sizes of field types, compressions.
WIDTH, HEIGHT, BITS, COMPRESSION, STRIP_AT, SAMPLES, STRIP_ROWS, STRIP_SIZE, PLANAR, PREDICTOR = 256, 257, 258, 259, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_AT, TILE_SIZE, FORMAT, PIXEL_SCALE, TIE_POINT, GEO_KEYS, NO_DATA = 322, 323, 324, 325, 339, 33550, 33922, 34735, 42113
TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}
NONE, LZW, DEFLATE, OLD_DEFLATE = 1, 5, 8, 32946
PROJECTED, GEOGRAPHIC = 3072, 2048
TILE = 512


@dataclass(frozen=True)
class Layout:
    """What a file's header says."""

    width: int
    height: int
    bands: int
    dtype: str
    compression: int
    predictor: int
    separate: bool
    block_width: int
    block_height: int
    offsets: tuple[int, ...]
    sizes: tuple[int, ...]
    no_data: float | None
    epsg: int | None
    transform: tuple[float, float, float, float] | None  # x and y of the upper left corner, width and height of a pixel

    @property
    def across(self) -> int:
        return -(-self.width // self.block_width)

    @property
    def down(self) -> int:
        return -(-self.height // self.block_height)

    def blocks(self, bands: tuple[int, ...] | None, window: tuple[int, int, int, int] | None) -> list[tuple[int, int, int, int]]:
        """(number, first band or 0 for all, y, x) of the blocks that hold pixels of the window (x0, y0, x1, y1) and of the bands."""
        x0, y0, x1, y1 = window or (0, 0, self.width, self.height)
        each = self.across * self.down
        out = []
        for n in range(len(self.offsets)):
            band = n // each + 1 if self.separate else 0
            y, x = n % each // self.across * self.block_height, n % self.across * self.block_width
            if x < x1 and y < y1 and x + self.block_width > x0 and y + self.block_height > y0 and (not band or not bands or band in bands):
                out.append((n, band, y, x))
        return out


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def files_of(path: str, endings: tuple[str, ...] = (".tif", ".tiff")) -> list[str]:
    """The files of a folder, or the file itself, sorted; names that begin with a dot or an underscore don't count."""
    store, inner = file_system(path)
    if store.get_file_info(inner).type != pafs.FileType.Directory:
        return [path]
    found = sorted(i.path for i in store.get_file_info(pafs.FileSelector(inner, recursive=True)) if i.type == pafs.FileType.File)
    prefix = path[: len(path) - len(inner)] if path.endswith(inner) else path.split(inner.strip("/").split("/")[0])[0]
    return [prefix + f for f in found if f.lower().endswith(endings) and f.rsplit("/", 1)[-1][0] not in "._"]


def parse(read) -> Layout:
    """The first image of a file; ``read(at, n)`` gives bytes."""
    head = read(0, 8)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    if not order or struct.unpack(f"{order}H", head[2:4])[0] != 42:
        raise ValueError("not a TIFF file")
    at = struct.unpack(f"{order}I", head[4:])[0]
    n = struct.unpack(f"{order}H", read(at, 2))[0]
    tags: dict[int, tuple] = {}
    raw = read(at + 2, 12 * n)
    for i in range(n):
        tag, kind, count = struct.unpack(f"{order}HHI", raw[12 * i : 12 * i + 8])
        if kind not in TYPES:
            continue
        size = struct.calcsize(TYPES[kind]) * count
        data = raw[12 * i + 8 : 12 * i + 12][:size] if size <= 4 else read(struct.unpack(f"{order}I", raw[12 * i + 8 : 12 * i + 12])[0], size)
        tags[tag] = (data.rstrip(b"\0").decode("latin-1"),) if kind == 2 else struct.unpack(f"{order}{count}{TYPES[kind]}", data)
    one = lambda tag, other: tags.get(tag, (other,))[0]
    bits, kind = one(BITS, 1), {1: "u", 2: "i", 3: "f"}.get(one(FORMAT, 1))
    if bits not in (8, 16, 32, 64) or not kind or len(set(tags.get(BITS, (1,)))) > 1 or one(COMPRESSION, 1) not in (NONE, LZW, DEFLATE, OLD_DEFLATE) or one(PREDICTOR, 1) not in (1, 2):
        raise ValueError(f"pixels of {bits} bits, format {one(FORMAT, 1)}, compression {one(COMPRESSION, 1)}, predictor {one(PREDICTOR, 1)} can't be read")
    tiled = TILE_AT in tags
    keys = tags.get(GEO_KEYS, ())
    codes = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}
    transform = None
    if PIXEL_SCALE in tags and TIE_POINT in tags:
        sx, sy, (i, j, _, x, y, _) = *tags[PIXEL_SCALE][:2], tags[TIE_POINT][:6]
        transform = (x - i * sx, y + j * sy, sx, sy)
    return Layout(
        one(WIDTH, 0),
        one(HEIGHT, 0),
        one(SAMPLES, 1),
        f"{order}{kind}{bits // 8}",
        one(COMPRESSION, 1),
        one(PREDICTOR, 1),
        one(PLANAR, 1) == 2,
        one(TILE_WIDTH, 0) if tiled else one(WIDTH, 0),
        one(TILE_HEIGHT, 0) if tiled else min(one(STRIP_ROWS, one(HEIGHT, 0)), one(HEIGHT, 0)),
        tuple(tags[TILE_AT if tiled else STRIP_AT]),
        tuple(tags[TILE_SIZE if tiled else STRIP_SIZE]),
        float(tags[NO_DATA][0]) if tags.get(NO_DATA, ("",))[0].strip() else None,
        codes.get(PROJECTED) or codes.get(GEOGRAPHIC),
        transform,
    )


def unpack_lzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, high bits first; 256 clears the table, 257 ends."""
    out, table, width, held, bits, last = [], [], 9, 0, 0, b""
    for byte in data:
        held, bits = (held << 8 | byte) & 0xFFFFFF, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits & (1 << width) - 1
        if code == 257:
            break
        if code == 256:
            table, width, last = [bytes([i]) for i in range(256)] + [b"", b""], 9, b""
            continue
        own = table[code] if code < len(table) else last + last[:1]
        out.append(own)
        if last:
            table.append(last + own[:1])
        last = own
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return b"".join(out)


def decode(layout: Layout, data: bytes, rows: int) -> np.ndarray:
    """(rows, columns, samples) of a block."""
    if layout.compression == LZW:
        data = unpack_lzw(data)
    elif layout.compression != NONE:
        data = zlib.decompress(data)
    samples = 1 if layout.separate else layout.bands
    a = np.frombuffer(data, layout.dtype, rows * layout.block_width * samples).reshape(rows, layout.block_width, samples)
    if layout.predictor == 2:
        a = np.cumsum(a.astype(a.dtype.newbyteorder("=")), axis=1, dtype=a.dtype.newbyteorder("="))
    return a


@dataclass
class Blocks(InputPartition):
    path: str
    layout: Layout
    blocks: list[tuple[int, int, int, int]]


def _numbers(text: str | None) -> tuple[int, ...] | None:
    return tuple(int(x) for x in text.split(",")) if text else None


class GeoTiffReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.bands, self.window = options["path"], _numbers(options.get("bands")), _numbers(options.get("window"))
        self.pixels = int(float(options.get("block_mb", "16")) * 1e6 / 8)

    def partitions(self) -> list[Blocks]:
        out = []
        for path in files_of(self.path):
            store, inner = file_system(path)
            with store.open_input_file(inner) as f:
                layout = parse(lambda at, n: f.read_at(n, at))  # noqa: B023
            found = layout.blocks(self.bands, self.window)
            each = max(1, self.pixels // (layout.block_width * layout.block_height * (1 if layout.separate else layout.bands)))
            out += [Blocks(path, layout, found[i : i + each]) for i in range(0, len(found), each)]
        return out or [Blocks("", None, [])]

    def read(self, part: Blocks) -> Iterator[pa.RecordBatch]:
        if not part.blocks:
            return
        layout, (store, inner) = part.layout, file_system(part.path)
        x0, y0, x1, y1 = self.window or (0, 0, layout.width, layout.height)
        with store.open_input_file(inner) as f:
            for n, band, y, x in part.blocks:
                # a last strip is shorter, a tile never is
                rows = layout.block_height if layout.block_width < layout.width or layout.block_height == TILE else min(layout.block_height, layout.height - y)
                a = decode(layout, f.read_at(layout.sizes[n], layout.offsets[n]), rows)
                top, left = max(y, y0), max(x, x0)
                a = a[top - y : min(y1, layout.height) - y, left - x : min(x1, layout.width) - x]
                for s in range(a.shape[2]):
                    number = band or s + 1
                    if self.bands and number not in self.bands:
                        continue
                    v = a[:, :, s].astype(np.float64)
                    iy, ix = np.nonzero(~np.isnan(v) if layout.no_data is None or np.isnan(layout.no_data) else ~np.isnan(v) & (v != layout.no_data))
                    cols = [pa.array([part.path] * len(iy), pa.string()), pa.array(np.full(len(iy), number, np.int32)), pa.array((iy + top).astype(np.int32)), pa.array((ix + left).astype(np.int32)), pa.array(v[iy, ix])]
                    yield pa.RecordBatch.from_arrays(cols, names=["path", "band", "y", "x", "value"])


def encode(width: int, height: int, bands: int, dtype: str, tiles: dict[tuple[int, int, int], np.ndarray], no_data: float, epsg: int | None, transform: tuple[float, float, float, float] | None) -> bytes:
    """A tiled, deflated file of separate bands; ``tiles``: (band, tile row, tile column) to TILE x TILE pixels, absent ones have no data."""
    kind = np.dtype(dtype)
    across, down = -(-width // TILE), -(-height // TILE)
    body, offsets, sizes, blank = [], [], [], np.full((TILE, TILE), no_data, kind)
    at = 8
    for b in range(1, bands + 1):
        for ty in range(down):
            for tx in range(across):
                a = tiles.get((b, ty, tx), blank)
                if kind.kind != "f":  # horizontal differences are for whole numbers
                    a = np.diff(a, axis=1, prepend=np.zeros((TILE, 1), kind))
                data = zlib.compress(np.ascontiguousarray(a, kind.newbyteorder("<")).tobytes(), 6)
                data += b"\0" * (len(data) % 2)
                body.append(data), offsets.append(at), sizes.append(len(data))
                at += len(data)
    tags = [(WIDTH, 4, [width]), (HEIGHT, 4, [height]), (BITS, 3, [kind.itemsize * 8] * bands), (COMPRESSION, 3, [DEFLATE]), (262, 3, [1]), (SAMPLES, 3, [bands]), (PLANAR, 3, [2]), (PREDICTOR, 3, [1 if kind.kind == "f" else 2])]
    tags += [(TILE_WIDTH, 3, [TILE]), (TILE_HEIGHT, 3, [TILE]), (TILE_AT, 4, offsets), (TILE_SIZE, 4, sizes), (FORMAT, 3, [{"u": 1, "i": 2, "f": 3}[kind.kind]] * bands)]
    if transform:
        x, y, sx, sy = transform
        tags += [(PIXEL_SCALE, 12, [sx, sy, 0.0]), (TIE_POINT, 12, [0.0, 0.0, 0.0, x, y, 0.0])]
    if epsg:
        geographic = 4000 <= epsg < 5000
        tags.append((GEO_KEYS, 3, [1, 1, 0, 2, 1024, 0, 1, 2 if geographic else 1, GEOGRAPHIC if geographic else PROJECTED, 0, 1, epsg]))
    tags.append((NO_DATA, 2, f"{no_data:g}\0".encode()))
    directory, more, far = [struct.pack("<H", len(tags))], [], at + 2 + 12 * len(tags) + 4
    for tag, kind_, values in tags:
        data = values if kind_ == 2 else struct.pack(f"<{len(values)}{TYPES[kind_]}", *values)
        entry = struct.pack("<HHI", tag, kind_, len(values))
        if len(data) <= 4:
            directory.append(entry + data.ljust(4, b"\0"))
        else:
            directory.append(entry + struct.pack("<I", far))
            more.append(data + b"\0" * (len(data) % 2))
            far += len(more[-1])
    if far >= 1 << 32:
        raise ValueError("over 4 GB: cut the layer into more files")
    return b"".join([b"II*\0", struct.pack("<I", at), *body, *directory, b"\0\0\0\0", *more])


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class GeoTiffWriter(DataSourceArrowWriter):
    """Rows (file, band, y, x, value, x0, y0) in the order of ``file``, whose corner is (x0, y0) if these aren't null; a task holds one file's tiles at a time."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.options, self.path = options, options["path"].rstrip("/")
        self.size = tuple(int(options[k]) for k in ("width", "height", "bands"))
        self.dtype, self.no_data = options.get("dtype", "int16"), float(options.get("no_data", "-9999"))
        self.epsg = int(options["epsg"]) if options.get("epsg") else None
        self.transform = tuple(float(x) for x in options["transform"].split(",")) if options.get("transform") else None

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        store, folder = file_system(self.path)
        store.create_dir(folder, recursive=True)
        width, height, bands = self.size
        done, now, corner, tiles = [], None, (None, None), {}

        def close() -> None:
            transform = self.transform if corner[0] is None or not self.transform else (*corner, *self.transform[2:])
            data = encode(width, height, bands, self.dtype, tiles, self.no_data, self.epsg, transform)
            temporary = f"{folder}/.{uuid.uuid4().hex}.part"
            with store.open_output_stream(temporary) as f:
                f.write(data)
            done.append((temporary, f"{folder}/{now}.tif"))
            tiles.clear()

        try:
            for b in batches:
                names = b.column(b.schema.get_field_index("file")).cast(pa.string()).to_numpy(zero_copy_only=False)
                band, y, x, v = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("band", "y", "x", "value"))
                edges = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)] if len(names) else [0]
                for a, e in zip(edges, edges[1:]):
                    if names[a] != now:
                        if now is not None:
                            close()
                        now, corner = names[a], tuple(b.column(b.schema.get_field_index(c))[a].as_py() for c in ("x0", "y0"))
                    own = slice(a, e)
                    if (y[own] >= height).any() or (x[own] >= width).any() or (band[own] > bands).any() or min(y[own].min(), x[own].min(), band[own].min() - 1) < 0:
                        raise ValueError(f"pixels of {now} outside {width} x {height} x {bands}")
                    key = np.stack([band[own], y[own] // TILE, x[own] // TILE], 1)
                    for k in {tuple(r) for r in np.unique(key, axis=0).tolist()}:
                        if k not in tiles:
                            tiles[k] = np.full((TILE, TILE), self.no_data, self.dtype)
                        at = (key == k).all(axis=1)
                        values = v[own][at].astype(np.float64)
                        tiles[k][y[own][at] % TILE, x[own][at] % TILE] = np.where(np.isnan(values), self.no_data, values)
            if now is not None:
                close()
            return Written(done)
        except BaseException:
            for temporary, _ in done:
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


class GeoTiff(DataSource):
    @classmethod
    def name(cls) -> str:
        return "geotiff"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> GeoTiffReader:
        return GeoTiffReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> GeoTiffWriter:
        return GeoTiffWriter(self.options, overwrite)


def read_geotiff(spark: SparkSession, path: str, bands: list[int] | None = None, window: tuple[int, int, int, int] | None = None) -> DataFrame:
    """(path, band, y, x, value) of a file or of all in a folder."""
    spark.dataSource.register(GeoTiff)
    r = spark.read.format("geotiff")
    r = r.option("bands", ",".join(map(str, bands))) if bands else r
    return (r.option("window", ",".join(map(str, window))) if window else r).load(path)


def write_geotiff(layer: DataFrame, path: str, file: str, width: int, height: int, bands: int = 1, dtype: str = "int16", no_data: float = -9999, epsg: int | None = None, transform: tuple | None = None) -> None:
    """A file for each value of the column ``file`` of rows (file, band, y, x, value); with columns x0 and y0 these are the file's corner instead of that of ``transform``."""
    layer.sparkSession.dataSource.register(GeoTiff)
    rows = layer.select(F.col(file).cast("string").alias("file"), F.col("band").cast("int").alias("band"), F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x"), F.col("value").cast("double").alias("value"),
        *((F.col(c) if c in layer.columns else F.lit(None)).cast("double").alias(c) for c in ("x0", "y0")))
    w = rows.repartition("file").sortWithinPartitions("file", "y").write.format("geotiff").mode("append")
    for k, v in {"width": width, "height": height, "bands": bands, "dtype": dtype, "no_data": no_data, "epsg": epsg or "", "transform": ",".join(map(repr, transform)) if transform else ""}.items():
        w = w.option(k, str(v))
    w.save(path)


def file_layouts(spark: SparkSession, path: str) -> DataFrame:
    """(path, width, height, bands, dtype, crs, x0, y0, pixel_width, pixel_height, no_data) by the files' headers."""
    schema = "path string, width int, height int, bands int, dtype string, crs string, x0 double, y0 double, pixel_width double, pixel_height double, no_data double"

    def headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for p in b.column(0).to_pylist():
                store, inner = file_system(p)
                with store.open_input_file(inner) as f:
                    own = parse(lambda at, n: f.read_at(n, at))  # noqa: B023
                rows.append((p, own.width, own.height, own.bands, own.dtype, own.epsg and f"EPSG:{own.epsg}", *(own.transform or (None,) * 4), own.no_data))
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), *[pa.float64()] * 5]
            names = [f.split(" ")[0] for f in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds], names=names)

    found = files_of(path)
    return spark.createDataFrame([(p,) for p in found], "path string").repartition(max(1, min(len(found), 64))).mapInArrow(headers, schema)


def read_mosaic(spark: SparkSession, path: str, bands: list[int] | None = None) -> DataFrame:
    """(band, row, column, value) of all files of a folder on one grid, whose corner is the least x and the largest y of theirs; of pixels that several files have the greatest value. Files
    must have one reference system and one pixel size."""
    own = file_layouts(spark, path)
    grid = own.agg(F.min("x0").alias("x"), F.max("y0").alias("y"), F.min("pixel_width").alias("w"), F.min("pixel_height").alias("h"), F.count_distinct("crs", "pixel_width", "pixel_height").alias("n")).first()
    if not grid or grid["x"] is None or grid["n"] != 1:
        raise ValueError("the files have no transform, or not one pixel size and reference system")
    at = own.select("path", F.round((F.lit(grid["y"]) - F.col("y0")) / grid["h"]).cast("int").alias("down"), F.round((F.col("x0") - grid["x"]) / grid["w"]).cast("int").alias("right"))
    rows = read_geotiff(spark, path, bands).join(at, "path").select("band", (F.col("y") + F.col("down")).alias("row"), (F.col("x") + F.col("right")).alias("column"), "value")
    return rows.groupBy("band", "row", "column").agg(F.max("value").alias("value"))


def best_band(pixels: DataFrame) -> DataFrame:
    """(path, y, x, value): the greatest value of a pixel's bands."""
    return pixels.groupBy("path", "y", "x").agg(F.max("value").alias("value"))

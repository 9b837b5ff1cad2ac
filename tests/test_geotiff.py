import struct
import zlib

import numpy as np
import pytest

from verdure.sources import geotiff as G


def pack_lzw(data: bytes) -> bytes:
    """A plain encoder for the tests: literals and known strings, codes of 9 to 12 bits, high bits first."""
    table, out, width, last = {bytes([i]): i for i in range(256)}, [(256, 9)], 9, b""
    size = 258
    for i in range(len(data)):
        c = data[i : i + 1]
        if last + c in table:
            last += c
            continue
        out.append((table[last], width))
        table[last + c] = size
        size += 1
        width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
        if size >= 4094:
            out.append((256, width))
            table, size, width = {bytes([i]): i for i in range(256)}, 258, 9
        last = c
    if last:
        out.append((table[last], width))
        width = 9 if size + 1 < 512 else 10 if size + 1 < 1024 else 11 if size + 1 < 2048 else 12
    out.append((257, width))
    bits = "".join(f"{c:0{w}b}" for c, w in out)
    bits += "0" * (-len(bits) % 8)
    return bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8))


def strips(a: np.ndarray, order: str, compression: int, predictor: int, rows: int, no_data=None) -> bytes:
    """A striped file of chunky bands, (height, width, bands)."""
    h, w, n = a.shape
    kind = a.dtype.newbyteorder(order)
    body, offsets, sizes, at = [], [], [], 8
    for y in range(0, h, rows):
        part = a[y : y + rows]
        part = np.diff(part, axis=1, prepend=np.zeros((len(part), 1, n), a.dtype)) if predictor == 2 else part
        data = np.ascontiguousarray(part, kind).tobytes()
        data = pack_lzw(data) if compression == 5 else zlib.compress(data) if compression == 8 else data
        body.append(data), offsets.append(at), sizes.append(len(data))
        at += len(data)
    code = {"u": 1, "i": 2, "f": 3}[a.dtype.kind]
    tags = [(256, 4, [w]), (257, 4, [h]), (258, 3, [a.dtype.itemsize * 8] * n), (259, 3, [compression]), (273, 4, offsets), (277, 3, [n]), (278, 4, [rows]), (279, 4, sizes), (317, 3, [predictor]), (339, 3, [code] * n)]
    if no_data is not None:
        tags.append((42113, 2, f"{no_data}\0".encode()))
    head, more, far = [struct.pack(f"{order}H", len(tags))], [], at + 2 + 12 * len(tags) + 4
    for tag, t, v in tags:
        data = v if t == 2 else struct.pack(f"{order}{len(v)}{G.TYPES[t]}", *v)
        entry = struct.pack(f"{order}HHI", tag, t, len(v))
        if len(data) <= 4:
            head.append(entry + data.ljust(4, b"\0"))
        else:
            head.append(entry + struct.pack(f"{order}I", far))
            more.append(data)
            far += len(data)
    return b"".join([b"II" if order == "<" else b"MM", struct.pack(f"{order}HI", 42, at), *body, *head, b"\0\0\0\0", *more])


def rows_of(a: np.ndarray, keep=lambda v: True, band=None) -> set:
    return {(b + 1, y, x, float(v)) for (y, x, b), v in np.ndenumerate(a) if keep(v)}


@pytest.mark.parametrize("order,compression,predictor,kind", [("<", 1, 1, "uint8"), (">", 5, 2, "int16"), ("<", 8, 2, "uint16"), (">", 8, 1, "float32"), ("<", 5, 1, "float64")])
def test_strips(spark, tmp_path, order, compression, predictor, kind):
    rng = np.random.default_rng(3)
    a = (rng.integers(0, 9, (37, 23, 2)) * 13).astype(kind)
    (tmp_path / "a.tif").write_bytes(strips(a, order, compression, predictor, 8, 13))
    df = G.read_geotiff(spark, str(tmp_path))
    assert {(r["band"], r["y"], r["x"], r["value"]) for r in df.collect()} == rows_of(a, lambda v: v != 13)
    part = G.read_geotiff(spark, str(tmp_path / "a.tif"), [2], (4, 9, 11, 30)).collect()
    assert {(r["band"], r["y"], r["x"], r["value"]) for r in part} == {r for r in rows_of(a, lambda v: v != 13) if r[0] == 2 and 9 <= r[1] < 30 and 4 <= r[2] < 11}


def test_lzw_of_all_lengths():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 300, 5_000, 40_000):
        data = rng.integers(0, 5 if n < 10_000 else 256, n).astype(np.uint8).tobytes()
        assert G.unpack_lzw(pack_lzw(data)) == data


def test_blocks_are_partitions_and_pruned(tmp_path):
    a = np.arange(64 * 10).reshape(64, 10, 1).astype("int32")
    (tmp_path / "a.tif").write_bytes(strips(a, "<", 1, 1, 4))
    reader = lambda **o: G.GeoTiffReader({"path": str(tmp_path), **o})
    assert len(reader(block_mb="0.0004").partitions()) == 16
    assert [b[2] for p in reader(window="0,9,10,17").partitions() for b in p.blocks] == [8, 12, 16]
    assert reader().partitions()[0].layout.transform is None


def test_round_trip(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(f"t{t}", b, int(y), int(x), float(v)) for t in range(3) for b in (1, 2) for y, x, v in zip(rng.integers(0, 700, 400), rng.integers(0, 530, 400), rng.integers(-50, 900, 400))]
    rows = list({r[:4]: r for r in rows}.values()) + [("t9", 1, 699, 529, None)]
    df = spark.createDataFrame(rows, "tile string, band int, y int, x int, value double").repartition(5)
    G.write_geotiff(df, str(tmp_path / "out"), "tile", 530, 700, 2, epsg=32643, transform=(300000.0, 4000020.0, 10.0, 10.0))
    got = G.read_geotiff(spark, str(tmp_path / "out")).collect()
    assert {(r["path"].rsplit("/", 1)[-1][:-4], r["band"], r["y"], r["x"], r["value"]) for r in got} == {r for r in rows if r[4] is not None} and len(got) == len(rows) - 1
    meta = G.file_layouts(spark, str(tmp_path / "out")).collect()
    assert len(meta) == 4 and all(m["crs"] == "EPSG:32643" and (m["x0"], m["y0"], m["pixel_width"], m["no_data"]) == (300000.0, 4000020.0, 10.0, -9999.0) for m in meta)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["t0.tif", "t1.tif", "t2.tif", "t9.tif"]


def test_failed_write_leaves_no_file(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 0, 0, 1.0), ("b", 1, 99, 0, 1.0)], "tile string, band int, y int, x int, value double")
    with pytest.raises(Exception, match="outside"):
        G.write_geotiff(df.repartition(1), str(tmp_path / "out"), "tile", 10, 10)
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.endswith(".tif")]


def test_what_cannot_be_read(tmp_path):
    (tmp_path / "a.tif").write_bytes(b"II*\0junk"[:4] + b"\0" * 4)
    with pytest.raises(ValueError, match="."):
        G.parse(lambda at, n: b"XX*\0\0\0\0\0")
    assert G.GeoTiffReader({"path": str(tmp_path / "none")}).path

import struct
from datetime import date

import numpy as np
import pytest

from verdure.sources import grids
from verdure.sources import netcdf as N


def packed(name: str) -> bytes:
    return struct.pack(">i", len(name)) + name.encode() + b"\0" * (-len(name) % 4)


def attributes(own: dict) -> bytes:
    if not own:
        return struct.pack(">ii", 0, 0)
    out = struct.pack(">ii", 12, len(own))
    for k, v in own.items():
        data = v.encode() if isinstance(v, str) else np.array([v], ">f4").tobytes()
        out += packed(k) + struct.pack(">ii", 2 if isinstance(v, str) else 5, len(v) if isinstance(v, str) else 1) + data + b"\0" * (-len(data) % 4)
    return out


def cube(a: np.ndarray, first: int, version: int = 2, unlimited: bool = True) -> bytes:
    """RAINFALL(TIME, LATITUDE, LONGITUDE) of ``a`` in 32-bit floats, and TIME in days since 1900-12-31."""
    n, h, w = a.shape
    dims = struct.pack(">ii", 10, 3) + packed("TIME") + struct.pack(">i", 0 if unlimited else n) + packed("LATITUDE") + struct.pack(">i", h) + packed("LONGITUDE") + struct.pack(">i", w)
    times, body = np.arange(first, first + n).astype(">f8"), a.astype(">f4")
    kinds = [("TIME", [0], attributes({"units": "days since 1900-12-31"}), 6, 8), ("RAINFALL", [0, 1, 2], attributes({"_FillValue": -999.0}), 5, h * w * 4)]

    def head(begins):
        out = b"CDF" + bytes([version]) + struct.pack(">i", n if unlimited else 0) + dims + attributes({"title": "test"}) + struct.pack(">ii", 11, 2)
        for (name, ids, own, kind, size), begin in zip(kinds, begins):
            out += packed(name) + struct.pack(f">{len(ids) + 1}i", len(ids), *ids) + own + struct.pack(">ii", kind, size) + struct.pack(">i" if version == 1 else ">q", begin)
        return out

    at = len(head([0, 0]))
    if unlimited:
        return head([at, at + 8]) + b"".join(times[i : i + 1].tobytes() + body[i].tobytes() for i in range(n))
    return head([at, at + 8 * n]) + times.tobytes() + body.tobytes()


@pytest.mark.parametrize("version,unlimited", [(1, True), (2, True), (1, False), (2, False)])
def test_records(spark, tmp_path, version, unlimited):
    a = np.arange(4 * 3 * 5).reshape(4, 3, 5).astype(float)
    a[1, 2, 3] = -999
    (tmp_path / "a.nc").write_bytes(cube(a, 40000, version, unlimited))
    got = N.read_netcdf(spark, str(tmp_path), "RAINFALL").collect()
    assert {(r["record"], r["y"], r["x"], r["value"]) for r in got} == {(*i, v) for i, v in np.ndenumerate(a) if v != -999}
    part = N.read_netcdf(spark, str(tmp_path / "a.nc"), "RAINFALL", (2, 3)).collect()
    assert {r["record"] for r in part} == {2} and len(part) == 15
    assert sorted(r["time"] for r in N.days_of(spark, str(tmp_path), "RAINFALL").collect())[0] == date(2010, 7, 7)


def test_one_record_is_read_alone(tmp_path):
    a = np.zeros((365, 20, 30))
    data = cube(a, 1)
    asked = []

    def read(at, n):
        asked.append(n)
        return data[at : at + n]

    v = N.parse(read)["RAINFALL"]
    before = sum(asked)
    N.values(read, v, 200, 201)
    assert sum(asked) - before == 20 * 30 * 4
    (tmp_path / "a.nc").write_bytes(data)
    parts = N.NetCdfReader({"path": str(tmp_path), "variable": "RAINFALL", "block_mb": "0.048"}).partitions()
    assert len(parts) == 37 and parts[-1].last == 365


def test_same_rows_as_the_binary_grid(spark, tmp_path):
    rng = np.random.default_rng(1)
    days = rng.random((3, grids.ROWS, grids.COLUMNS)).astype("<f4") * 50
    days[0, 5, 6] = -999
    (tmp_path / "nc").mkdir(), (tmp_path / "grd").mkdir()
    first = (date(2019, 6, 1) - date(1900, 12, 31)).days
    (tmp_path / "nc" / "r2019.nc").write_bytes(cube(days[:2], first))
    for i, own in enumerate((days[0] + 1, days[1] + 1, days[2])):
        (tmp_path / "grd" / f"rain_2019060{i + 1}.grd").write_bytes(own.astype("<f4").tobytes())
    both = N.read_rainfall(spark, str(tmp_path / "nc"), str(tmp_path / "grd")).filter("rainfall is not null").collect()
    want = {(date(2019, 6, i + 1), iy, ix, float(v)) for (i, iy, ix), v in np.ndenumerate(days) if v >= 0}
    assert {(r["time"], r["iy"], r["ix"], r["rainfall"]) for r in both} == want
    r = [r for r in both if r["iy"] == 4 and r["ix"] == 8][0]
    assert (r["lat"], r["lon"]) == (7.5, 68.5)


def test_other_files(tmp_path):
    (tmp_path / "a.nc").write_bytes(b"\x89HDF\r\n\x1a\n" + b"\0" * 100)
    with pytest.raises(ValueError, match="classic"):
        N.NetCdfReader({"path": str(tmp_path), "variable": "x"}).partitions()

"""Geometries as well-known binary, in either byte order."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, StructField, StructType

#: Fixed values of the format: kinds of geometries, flags of the extended form.
POINT, LINE, POLYGON, SEVERAL = 1, 2, 3, (4, 5, 6, 7)
HEIGHT, MEASURE, SYSTEM = 0x80000000, 0x40000000, 0x20000000
POLYGONS = ArrayType(ArrayType(ArrayType(StructType([StructField("x", DoubleType()), StructField("y", DoubleType())]))))


@F.pandas_udf(BinaryType())
def _packed(xs: pd.Series, ys: pd.Series, little: pd.Series) -> pd.Series:
    out = []
    for x, y, le in zip(xs, ys, little):
        if x is None or not len(x):
            out.append(None)
            continue
        o = "<" if le else ">"
        points = np.column_stack([np.append(x, x[0]), np.append(y, y[0])])
        out.append(struct.pack(f"{o}BIII", int(le), POLYGON, 1, len(points)) + points.astype(f"{o}f8").tobytes())
    return pd.Series(out, dtype=object)


def to_wkb(ring: Column, little: Column | bool = True) -> Column:
    """A ring, array of struct<x, y>, as a polygon, closed; null for null and empty rings."""
    little = F.lit(little) if isinstance(little, bool) else little
    return _packed(F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"]), little)


def parse(data: bytes, at: int = 0) -> tuple[list, int]:
    """Polygons of a geometry, each a list of rings, and where it ends: a point is a ring of one point, a line one open ring; collections are the polygons of all their members."""
    order = "<" if data[at] == 1 else ">"
    kind = struct.unpack_from(f"{order}I", data, at + 1)[0]
    at += 5 + (4 if kind & SYSTEM else 0)
    code = kind & 0x0FFFFFFF
    n = 2 + bool(kind & HEIGHT) + bool(kind & MEASURE) + (0, 1, 1, 2)[code // 1000]
    code %= 1000
    if code in SEVERAL:
        count, at = struct.unpack_from(f"{order}I", data, at)[0], at + 4
        out = []
        for _ in range(count):
            some, at = parse(data, at)
            out += some
        return out, at

    def points(count: int) -> list:
        nonlocal at
        values = np.frombuffer(data, f"{order}f8", count * n, at).reshape(count, n)
        at += 8 * count * n
        return [{"x": x, "y": y} for x, y in values[:, :2].tolist()]

    def number() -> int:
        nonlocal at
        at += 4
        return struct.unpack_from(f"{order}I", data, at - 4)[0]

    if code == POINT:
        return [[points(1)]], at
    if code == LINE:
        return [[points(number())]], at
    if code != POLYGON:
        raise ValueError(f"geometries of kind {kind} aren't read")
    rings = [points(number()) for _ in range(number())]
    return ([[r[:-1] if len(r) > 1 and r[0] == r[-1] else r for r in rings]] if rings else []), at


@F.pandas_udf(POLYGONS)
def from_wkb(data: pd.Series) -> pd.Series:
    """The polygons of a geometry, each its outer ring and then its holes, rings not closed; null for null."""
    return pd.Series([None if d is None else parse(bytes(d))[0] for d in data], dtype=object)

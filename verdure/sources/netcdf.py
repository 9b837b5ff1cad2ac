"""NetCDF classic files (CDF-1 and CDF-2) as a Spark data source: a variable's records are read by ranges, a day without the rest of its year.

Rows are (path, record, y, x, value) of a variable of three dimensions, the first of them the unlimited one or a fixed one; fill values and missing values are left out. Coordinates come from
the variables named like the dimensions (``coordinates``). A partition is a run of records of about ``block_mb`` decoded; ``records`` names a range of them.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from .geotiff import file_system, files_of
from .grids import SOUTH, STEP, WEST, prefer, read_grd

#: Fixed values of the format: tags of lists, external types.
DIMENSIONS, VARIABLES, ATTRIBUTES = 10, 11, 12
TYPES = {1: "i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8"}


@dataclass(frozen=True)
class Variable:
    name: str
    shape: tuple[int, ...]
    dimensions: tuple[str, ...]
    dtype: str
    begin: int
    record: int  # bytes from one record to the next, 0: not a record variable
    attributes: dict

    def places(self, first: int, last: int) -> list[tuple[int, int]]:
        """(place, bytes) of the records first, ..., last - 1; neighbours as one."""
        size = int(np.prod(self.shape[1:], dtype=np.int64)) * np.dtype(self.dtype).itemsize
        if not self.record:
            return [(self.begin + first * size, (last - first) * size)]
        return [(self.begin + i * self.record, size) for i in range(first, last)]

    def missing(self, v: np.ndarray) -> np.ndarray:
        out = np.isnan(v) if v.dtype.kind == "f" else np.zeros(v.shape, bool)
        for name in ("_FillValue", "missing_value"):
            if name in self.attributes:
                out |= v == np.array(self.attributes[name]).astype(v.dtype).ravel()[0]
        return out


class _Header:
    """Reads a header from its beginning, more of the file as it is needed."""

    def __init__(self, read, size: int = 1 << 16):
        self.read, self.data, self.at = read, read(0, size), 0

    def take(self, n: int) -> bytes:
        while self.at + n > len(self.data):
            more = self.read(len(self.data), max(1 << 16, n))
            if not more:
                raise ValueError("the header ends too soon")
            self.data += more
        self.at += n
        return self.data[self.at - n : self.at]

    def number(self) -> int:
        return struct.unpack(">i", self.take(4))[0]

    def name(self) -> str:
        n = self.number()
        return self.take(n + -n % 4)[:n].decode()

    def attributes(self) -> dict:
        tag, n, out = self.number(), self.number(), {}
        for _ in range(n if tag == ATTRIBUTES else 0):
            name, kind, count = self.name(), self.number(), self.number()
            size = count * np.dtype(TYPES[kind]).itemsize
            data = self.take(size + -size % 4)[:size]
            out[name] = data.decode("latin-1").rstrip("\0") if kind == 2 else np.frombuffer(data, TYPES[kind])
        return out


def parse(read) -> dict[str, Variable]:
    """The variables of a file; ``read(at, n)`` gives bytes."""
    h = _Header(read)
    magic = h.take(4)
    if magic[:3] != b"CDF" or magic[3] not in (1, 2):
        raise ValueError("not a NetCDF classic file")
    records = h.number()
    if records < 0:
        raise ValueError("the number of records isn't known")
    tag, n = h.number(), h.number()
    dims = [(h.name(), h.number()) for _ in range(n if tag == DIMENSIONS else 0)]
    h.attributes()
    tag, n = h.number(), h.number()
    raw = []
    for _ in range(n if tag == VARIABLES else 0):
        name = h.name()
        ids = [h.number() for _ in range(h.number())]
        own, kind, size = h.attributes(), h.number(), h.number()
        begin = struct.unpack(">i" if magic[3] == 1 else ">q", h.take(4 if magic[3] == 1 else 8))[0]
        raw.append((name, ids, own, kind, size, begin))
    unlimited = lambda ids: bool(ids) and dims[ids[0]][1] == 0
    inner = {name: int(np.prod([dims[i][1] for i in ids[1:]], dtype=np.int64)) * np.dtype(TYPES[kind]).itemsize for name, ids, _, kind, _, _ in raw if unlimited(ids)}
    # alone in its records a variable isn't padded
    record = sum(s + -s % 4 for s in inner.values()) if len(inner) > 1 else sum(inner.values())
    return {name: Variable(name, tuple(records if dims[i][1] == 0 else dims[i][1] for i in ids), tuple(dims[i][0] for i in ids), TYPES[kind], begin, record if unlimited(ids) else 0, own) for name, ids, own, kind, _, begin in raw}


def values(read, v: Variable, first: int, last: int) -> np.ndarray:
    data = b"".join(read(at, n) for at, n in v.places(first, last))
    return np.frombuffer(data, v.dtype).reshape(last - first, *v.shape[1:])


@dataclass
class Records(InputPartition):
    path: str
    variable: Variable | None
    first: int
    last: int


class NetCdfReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.name = options["path"], options["variable"]
        self.range = tuple(int(x) for x in options["records"].split(",")) if options.get("records") else None
        self.pixels = float(options.get("block_mb", "16")) * 1e6 / 8

    def partitions(self) -> list[Records]:
        out = []
        for path in files_of(self.path, (".nc",)):
            store, inner = file_system(path)
            with store.open_input_file(inner) as f:
                v = parse(lambda at, n: f.read_at(n, at)).get(self.name)  # noqa: B023
            if v is None or len(v.shape) != 3:
                raise ValueError(f"{path} has no variable {self.name} of three dimensions")
            first, last = self.range or (0, v.shape[0])
            each = max(1, int(self.pixels // max(1, v.shape[1] * v.shape[2])))
            out += [Records(path, v, i, min(i + each, last, v.shape[0])) for i in range(first, min(last, v.shape[0]), each)]
        return out or [Records("", None, 0, 0)]

    def read(self, part: Records) -> Iterator[pa.RecordBatch]:
        if part.variable is None:
            return
        store, inner = file_system(part.path)
        with store.open_input_file(inner) as f:
            for i in range(part.first, part.last):
                a = values(lambda at, n: f.read_at(n, at), part.variable, i, i + 1)[0]
                iy, ix = np.nonzero(~part.variable.missing(a))
                cols = [pa.array([part.path] * len(iy), pa.string()), pa.array(np.full(len(iy), i, np.int32)), pa.array(iy.astype(np.int32)), pa.array(ix.astype(np.int32)), pa.array(a[iy, ix].astype(np.float64))]
                yield pa.RecordBatch.from_arrays(cols, names=["path", "record", "y", "x", "value"])


class NetCdf(DataSource):
    @classmethod
    def name(cls) -> str:
        return "netcdf3"

    def schema(self) -> str:
        return "path string, record int, y int, x int, value double"

    def reader(self, schema: StructType) -> NetCdfReader:
        return NetCdfReader(self.options)


def read_netcdf(spark: SparkSession, path: str, variable: str, records: tuple[int, int] | None = None) -> DataFrame:
    """(path, record, y, x, value) of a file or of all in a folder."""
    spark.dataSource.register(NetCdf)
    r = spark.read.format("netcdf3").option("variable", variable)
    return (r.option("records", ",".join(map(str, records))) if records else r).load(path)


def days_of(spark: SparkSession, path: str, variable: str) -> DataFrame:
    """(path, record, time): the date of each record, by the coordinate named like the variable's first dimension, in days since the date in its units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths, at, times = [], [], []
            for p in b.column(0).to_pylist():
                store, inner = file_system(p)
                with store.open_input_file(inner) as f:
                    read = lambda at, n: f.read_at(n, at)  # noqa: B023, E731
                    all_ = parse(read)
                    t = all_[all_[variable].dimensions[0]]
                    word, _, since, *_ = t.attributes["units"].split()
                    if word.lower() != "days":
                        raise ValueError(f"times of {p} are in {word}")
                    y, m, d = (int(x) for x in since.split("T")[0].split("-"))
                    days = values(read, t, 0, t.shape[0]).ravel()
                paths += [p] * len(days)
                at += range(len(days))
                times += [date(y, m, d) + timedelta(int(x)) for x in days]
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(at, pa.int32()), pa.array(times, pa.date32())], names=["path", "record", "time"])

    found = files_of(path, (".nc",))
    return spark.createDataFrame([(p,) for p in found], "path string").repartition(max(1, min(len(found), 64))).mapInArrow(run, "path string, record int, time date")


def read_rainfall_netcdf(spark: SparkSession, path: str, variable: str = "RAINFALL") -> DataFrame:
    """(time, iy, ix, lat, lon, rainfall) as ``grids.read_grd`` gives them, but for pixels without data, which are left out; negative values are null."""
    rows = read_netcdf(spark, path, variable).join(days_of(spark, path, variable), ["path", "record"])
    return rows.select("time", F.col("y").alias("iy"), F.col("x").alias("ix"), (F.lit(SOUTH) + F.col("y") * STEP).alias("lat"), (F.lit(WEST) + F.col("x") * STEP).alias("lon"), F.when(F.col("value") >= 0, F.col("value")).alias("rainfall"))


def read_rainfall(spark: SparkSession, netcdf: str, grd: str) -> DataFrame:
    """Days of the NetCDF files, and of the binary grids those that they don't have."""
    return prefer(read_rainfall_netcdf(spark, netcdf), read_grd(spark, grd))

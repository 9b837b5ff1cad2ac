"""Helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but space, tab, newline, vertical tab, form feed and carriage return.
#: ``bytes.split()`` cuts at exactly these six bytes.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir. Where it is unset a local master gets a new folder; on a cluster that is an error."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="verdure-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A folder in the shared one that holds the tables written meanwhile and goes at the end; what has to stay is ``stored`` with ``keep``."""
    path = f"{shared_dir(spark)}/verdure-{uuid.uuid4().hex[:12]}"
    token = _SCRATCH.set(path)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def workspace(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A fresh path in the shared folder, in the scratch folder if there is one."""
    own = _SCRATCH.get()
    return f"{own}/{uuid.uuid4().hex[:8]}-{name}" if own and not keep else f"{shared_dir(spark)}/verdure-{uuid.uuid4().hex[:12]}/{name}"


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` as a written table in the shared folder: lineage ends here and a lost executor loses nothing. With ``keep`` it outlives the scratch folder."""
    path = workspace(df.sparkSession, name, keep)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """``df`` as a table in the shared folder with its rows in buckets by ``key``, so that a join on it shuffles the other side only. The catalog's entry goes at once: no name is left
    behind, and the DataFrame reads the files."""
    spark, table = df.sparkSession, f"verdure_{uuid.uuid4().hex[:12]}"
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    df.write.bucketBy(n, key).option("path", workspace(spark, name)).option("compression", "zstd").saveAsTable(table)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, told by their exact spelling from others that differ in case only; without an exact one, the one that Spark would take."""
    own = numbered_columns(df)
    at = lambda n: df.columns.index(n) if n in df.columns else [c.lower() for c in df.columns].index(n.lower())
    return own.select(*(F.col(f"c{at(n)}").alias(n) for n in names))


def numbered_columns(df: DataFrame) -> DataFrame:
    """``df`` with its columns named c0, c1, ...: no name that an operator adds clashes with them. ``toDF(*df.columns)`` gives the names back."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


#: A key with more than this part of all rows is split off.
HOT = 10_000


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], n: str = "n", total: int | None = None) -> DataFrame:
    """``rows``, written already, joined with ``groups``: one row for each of the keys, with the number ``n`` of its rows. Keys that hold over a ten-thousandth of the rows, of which there
    are fewer than ten thousand, are broadcast and their rows stay where they are; the others are shuffled. So no task gets all rows of a frequent key, and what is broadcast is bounded.
    With ``total``, the sum of ``n``, the groups are written already and aren't written again."""
    if total is None:
        groups = stored(groups, "groups")
        total = groups.agg(F.sum(n)).first()[0] or 0
    hot = groups.filter(F.col(n) * HOT > F.lit(total))
    cold = groups.filter(F.col(n) * HOT <= F.lit(total))
    own = rows.join(F.broadcast(hot), keys)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return own.unionByName(rest)


#: Parts that a split key's rows are dealt into.
SALTS = 64


def semi_join_groups(rows: DataFrame, groups: DataFrame, key: str, spread: str, n: str = "n") -> DataFrame:
    """The ``rows`` whose key is in ``groups`` (written already, a row for each key with the number ``n`` of its rows), in one pass: rows of keys with over a ten-thousandth of all, of which
    there are fewer than ten thousand, are dealt by a hash of the column ``spread`` into parts that each have the key."""
    total = groups.agg(F.sum(n)).first()[0] or 0
    frequent = F.col(n) * HOT > F.lit(total)
    hot = groups.filter(frequent).select(key, F.lit(True).alias("hot"))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).otherwise(0)
    keys = groups.select(key, F.explode(F.when(frequent, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt"))
    return rows.join(F.broadcast(hot), key, "left").withColumn("salt", salt).join(keys, [key, "salt"], "left_semi").select(rows.columns)


def long_id(c: str) -> Column:
    return F.col(c).cast("long").alias(c)


def small(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """Batches of whole texts, ``rows`` at a time: what a task holds as Python objects stays small beside Spark's own batch size.

    At the end freed memory goes back to the system: a worker lives on, and the next stage's task may run beside it.
    """
    for b in batches:
        for at in range(0, max(1, b.num_rows), rows):
            yield b.slice(at, rows)
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)

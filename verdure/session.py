"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "verdure", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution; ``conf`` keys use ``__`` for dots."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share, the session's spark.checkpoint.dir; where it is unset a local master gets a new folder, and on a cluster that is an error."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="verdure-")
    return f"{base.rstrip('/')}/verdure-{uuid.uuid4().hex[:12]}/{name}"


def written(rows: DataFrame, name: str) -> DataFrame:
    """The rows from a table in a work folder: computed once, whatever reads them, and planned from there on."""
    path = work_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)

"""Incidents from a stream of submitted forms: each micro-batch adds its changes as a run, runs are merged in tiers, and of an incident the newest change by reporting date counts.

A run is a folder ``run_a_b`` with the newest change of each incident in the batches a to b. A batch writes ``run_n_n``; after every ``FAN`` batches their runs become one, after ``FAN`` of these
they become one again, and so on: a row is written once a tier, and a reader opens at most ``FAN`` - 1 runs a tier. A run counts when Spark has marked it as whole, and makes those inside its span
void; these are removed by a later merge, so that readers that still list them can finish. A batch that runs again after a failure replaces its own run, and its merge.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdure.operators import incidents

SCHEMA = "incident_id string, form_id long, region_id int, latitude double, longitude double, request_id double, category string, species string, status string, village string, beat_naka string, rescue_date date, description string, label string, reporting_date date"
#: How many runs of a tier become one.
FAN = 8

Span = tuple[int, int]


def _folder(spark: SparkSession, path: str):
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), root


def runs(spark: SparkSession, path: str) -> list[Span]:
    """The whole runs in a folder."""
    fs, root = _folder(spark, path)
    if not fs.exists(root):
        return []
    names = [re.fullmatch(r"run_(\d+)_(\d+)", s.getPath().getName()) for s in fs.listStatus(root)]
    mark = lambda m: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{m[0]}/_SUCCESS")
    return sorted((int(m[1]), int(m[2])) for m in names if m and fs.exists(mark(m)))


def outer(spans: list[Span]) -> list[Span]:
    """The spans that lie in no other."""
    return [(a, b) for a, b in spans if not any(c <= a and b <= d and (c, d) != (a, b) for c, d in spans)]


def newest(rows: DataFrame) -> DataFrame:
    """Of each incident the row of the last reporting date, of one date that of the last batch."""
    others = [c for c in rows.columns if c not in ("incident_id", "reporting_date", "batch")]
    last = rows.groupBy("incident_id").agg(F.max(F.struct("reporting_date", "batch", *others)).alias("r"))
    return last.select(*(F.col("incident_id") if c == "incident_id" else F.col("r")[c].alias(c) for c in rows.columns))


def _read(spark: SparkSession, path: str, spans: list[Span], schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, batch long").parquet(*(f"{path}/run_{a}_{b}" for a, b in spans))


def current(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    """The incident table."""
    spans = outer(runs(spark, path))
    return newest(_read(spark, path, spans, schema)).drop("batch") if spans else spark.createDataFrame([], schema)


def merge(spark: SparkSession, path: str, batch: int, fan: int = FAN, schema: str = SCHEMA) -> None:
    """The merge that is due after a batch, if one is: the greatest power of ``fan`` that divides the number of batches so far says how many of them become one run."""
    width = fan
    while (batch + 1) % (width * fan) == 0:
        width *= fan
    if (batch + 1) % width:
        return
    first = batch + 1 - width
    every = runs(spark, path)
    inside = [s for s in every if first <= s[0] and s[1] <= batch and s != (first, batch)]
    void = [s for s in every if s not in outer(every) and not (first <= s[0] and s[1] <= batch)]
    if inside:
        newest(_read(spark, path, outer(inside), schema)).write.mode("overwrite").parquet(f"{path}/run_{first}_{batch}")
    void += [s for s in inside if s not in outer(inside)]
    fs, _ = _folder(spark, path)
    for a, b in void:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/run_{a}_{b}"), True)


def upsert_batch(path: str, fan: int = FAN) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: it writes the batch's incidents, whatever is stored, and merges runs when that is due. Of several rows of a form the last by reporting date counts, of one date
    the largest row."""

    def run(batch: DataFrame, batch_id: int) -> None:
        others = [c for c in batch.columns if c not in ("form_id", "reporting_date")]
        last = batch.groupBy("form_id").agg(F.max(F.struct("reporting_date", *others)).alias("r")).select("form_id", "r.*")
        rows = incidents.extract(last, keep=("reporting_date",)).withColumn("batch", F.lit(batch_id).cast("long"))
        rows.write.mode("overwrite").parquet(f"{path}/run_{batch_id}_{batch_id}")
        merge(batch.sparkSession, path, batch_id, fan)

    return run


def start(attributes: DataFrame, path: str, checkpoint: str, fan: int = FAN):
    """Starts the stream over all that is there and returns its handle."""
    return attributes.writeStream.foreachBatch(upsert_batch(path, fan)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Publishing values as versioned product data, and changing stored incidents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdure.functions import exact


def publish(raw: DataFrame, region_codes: DataFrame, snapshots: DataFrame, products: DataFrame, product: str | None = None) -> DataFrame:
    """(snapshot_id, region_id, value): rows that find a region and a live snapshot of a live product."""
    live = products.filter("deleted_at is null")
    live = live.filter(F.col("name") == product) if product else live
    snaps = snapshots.filter("deleted_at is null").join(live.select(F.col("id").alias("product_id")), "product_id").select(F.col("id").alias("snapshot_id"), "label")
    return raw.filter("value is not null").join(region_codes, "code").join(snaps, "label").select("snapshot_id", "region_id", F.to_json(F.struct(exact.half_up(F.col("value"), 2).alias("value"))).alias("value"))


def rejects(raw: DataFrame, region_codes: DataFrame, snapshots: DataFrame, products: DataFrame) -> DataFrame:
    """What ``publish`` leaves out, with the reason."""
    live = products.filter("deleted_at is null").select(F.col("id").alias("product_id"))
    labels = snapshots.filter("deleted_at is null").join(live, "product_id", "left_semi").select("label", F.lit(True).alias("has_label")).distinct()
    rows = raw.join(region_codes.select("code", F.lit(True).alias("has_region")), "code", "left").join(labels, "label", "left")
    reason = F.when(F.col("value").isNull(), "no value").when(F.col("has_region").isNull(), "no region").when(F.col("has_label").isNull(), "no snapshot")
    return rows.select("code", "label", "value", reason.alias("reason")).filter("reason is not null")


def snapshots_to_create(wanted: DataFrame, snapshots: DataFrame) -> DataFrame:
    """(product_id, label) that has no live snapshot yet."""
    return wanted.select("product_id", "label").distinct().join(snapshots.filter("deleted_at is null"), ["product_id", "label"], "left_anti")


def get_or_create(wanted: DataFrame, snapshots: DataFrame) -> DataFrame:
    """(product_id, label, id, created) of every wanted snapshot; a new one's id is a 64-bit hash of product and label, so asking again gives the same. A hash that some snapshot has as
    its id, live or deleted, is hashed again."""
    live = snapshots.filter("deleted_at is null").select("product_id", "label", F.col("id").cast("long").alias("id"), F.lit(False).alias("created"))
    taken = snapshots.select(F.col("id").cast("long").alias("taken")).distinct()
    new = snapshots_to_create(wanted, snapshots).withColumn("hash", F.xxhash64("product_id", "label")).join(taken, F.col("hash") == F.col("taken"), "left")
    new = new.select("product_id", "label", F.when(F.col("taken").isNull(), F.col("hash")).otherwise(F.xxhash64("hash", "product_id", "label")).alias("id"), F.lit(True).alias("created"))
    return wanted.select("product_id", "label").distinct().join(live.unionByName(new), ["product_id", "label"])


def of_snapshots(data: DataFrame, snapshots: DataFrame) -> DataFrame:
    return data.join(snapshots.select(F.col("id").alias("snapshot_id")), "snapshot_id", "left_semi")


def upsert(stored: DataFrame, changes: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """The stored rows with changed ones replaced and new ones added: a new version of the table. Of several changes of a key the one with the largest ``order`` counts, of equals, or
    without an order, the largest row."""
    rest = [c for c in changes.columns if c != key]
    first = [order] if order else []
    last = changes.groupBy(key).agg(F.max(F.struct(*first, *(c for c in rest if c not in first))).alias("r")).select(key, *(F.col("r")[c].alias(c) for c in rest))
    return stored.join(last.select(key), key, "left_anti").unionByName(last.select(*stored.columns))


def soft_delete(stored: DataFrame, gone: DataFrame, key: str, when: str) -> DataFrame:
    """Rows whose key is in ``gone`` and that live get deleted_at and updated_at."""
    marked = stored.join(gone.select(key, F.lit(True).alias("gone")).distinct(), key, "left")
    at = F.when(F.col("gone") & F.col("deleted_at").isNull(), F.lit(when).cast("date"))
    return marked.withColumns({"updated_at": F.coalesce(at, "updated_at"), "deleted_at": F.coalesce("deleted_at", at)}).drop("gone")


def insert_statements(published: DataFrame, table: str) -> DataFrame:
    """One SQL INSERT a row, for stores that take scripts."""
    return published.select(F.format_string(f"INSERT INTO {table} (data_product_snapshot_id, region_id, value) VALUES (%d, %d, '%s');", "snapshot_id", "region_id", F.replace("value", F.lit("'"), F.lit("''"))).alias("statement"))


def lookup_statements(raw: DataFrame, product: str, region_type: str | None = None, block: int = 1000) -> DataFrame:
    """(label, block, statement): scripts for a store that finds the ids itself: rows (code, label, value) by code among live regions, of a type if one is named, and by label among the live
    snapshots of a live product. One INSERT for each label and ``block`` rows of it, rows by code; values have two places, and rows without a value are left out."""
    text = lambda c: F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'"))
    quoted = lambda v: "'" + v.replace("'", "''") + "'"
    at = F.row_number().over(Window.partitionBy("label").orderBy("code", "value")) - 1
    rows = raw.filter("value is not null and code is not null and label is not null").withColumn("block", F.floor(at / block).cast("int"))
    value = exact.half_up(F.col("value"), 2).cast("decimal(18,2)").cast("string")
    row = F.concat(F.lit("("), text(F.col("code")), F.lit(", "), text(F.col("label")), F.lit(", "), value, F.lit(")"))
    lines = rows.groupBy("label", "block").agg(F.array_sort(F.collect_list(F.struct("code", row.alias("row")))).alias("rows"))
    kind = f" AND r.type = {quoted(region_type)}" if region_type else ""
    head = "INSERT INTO data_product_snapshots_data (data_product_snapshot_id, region_id, value, created_at, updated_at) SELECT s.id, r.id, to_jsonb(v.value), now(), now() FROM (VALUES "
    tail = f") AS v (code, label, value) JOIN regions AS r ON r.code = v.code AND r.deleted_at IS NULL{kind} JOIN data_product_snapshots AS s ON s.label = v.label AND s.deleted_at IS NULL JOIN data_products AS p ON p.id = s.data_product_id AND p.deleted_at IS NULL AND p.name = {quoted(product)};"
    return lines.select("label", "block", F.concat(F.lit(head), F.array_join(F.transform("rows", lambda r: r["row"]), ", "), F.lit(tail)).alias("statement"))

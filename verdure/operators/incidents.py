"""Rescue incidents from form submissions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAMES = ["latitude", "longitude", "request_id", "animal_category", "animal_species", "process_status", "village_town", "beat_naka", "date_of_reporting"]
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def rescue_date(text: Column) -> Column:
    """DD-MMM-YY or DD-MMM-YYYY, white space around it left out; months are case-sensitive, two-digit years are after 2000, and days that a month doesn't have are null."""
    part = lambda i: F.regexp_extract(F.btrim(text, F.lit(" \t\r\n")), r"^(\d{1,2})-([A-Z][a-z]{2})-(\d{4}|\d{2})$", i)
    month = F.array_position(F.array(*map(F.lit, MONTHS)), part(2))
    year = part(3).try_cast("int")
    year = F.when(year < 100, year + 2000).otherwise(year)
    return F.when(month > 0, F.to_date(F.try_to_timestamp(F.format_string("%04d-%02d-%02d", year, month, part(1).try_cast("int")), F.lit("yyyy-MM-dd"))))


def form_attributes(forms: DataFrame, values: DataFrame, template: str, region_id: int | None, start: str, end: str) -> DataFrame:
    """One row for each submitted form of a template, with its attributes as columns; of one name the value of the largest seq counts."""
    f = forms.filter(F.col("status").isin("submitted", "acknowledged") & (F.col("template") == template) & F.col("reporting_date").between(start, end))
    f = f if region_id is None else f.filter(F.col("region_id") == region_id)
    rows = f.join(values, "form_id", "left")
    return rows.groupBy("form_id", "region_id", "reporting_date").agg(*(F.max_by(F.when(F.col("name") == n, F.struct("value")), F.when(F.col("name") == n, F.col("seq")))["value"].alias(n) for n in NAMES))


def extract(attributes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Incidents: forms with numeric coordinates other than 0 and NaN, a category, a species and a valid date. Category, species and status are lower case; the description has them as
    they were written, and the request's number if it has one. ``keep``: further columns of the forms, as they are."""
    text = lambda c: F.nullif(F.btrim(F.coalesce(c, F.lit("")), F.lit(" \t\n\x0b\x0c\r")), F.lit(""))
    number = lambda c: F.col(c).try_cast("double")
    request = F.nanvl(F.coalesce(number("request_id"), F.lit(0.0)), F.lit(0.0))
    shown = F.when(request == F.floor(request), request.cast("long").cast("string")).otherwise(request.cast("string"))
    written = F.concat(text("animal_category"), F.lit(" - "), text("animal_species"), F.lit(" rescue"), F.when(request != 0, F.concat(F.lit(" (Request: "), shown, F.lit(")"))).otherwise(""))
    rows = attributes.select(
        F.format_string("rescue_%d", "form_id").alias("incident_id"), "form_id", "region_id", number("latitude").alias("latitude"), number("longitude").alias("longitude"),
        F.when(request > 0, request).alias("request_id"), F.lower(text("animal_category")).alias("category"), F.lower(text("animal_species")).alias("species"),
        F.coalesce(F.lower(text("process_status")), F.lit("unknown")).alias("status"), text("village_town").alias("village"), text("beat_naka").alias("beat_naka"),
        rescue_date(F.col("date_of_reporting")).alias("rescue_date"), written.alias("description"), *keep,
    )
    placed = "latitude <> 0 and longitude <> 0 and not isnan(latitude) and not isnan(longitude)"
    rows = rows.filter(f"{placed} and category is not null and species is not null and rescue_date is not null")
    return rows.withColumn("label", F.format_string("animal_rescue_%d", F.year("rescue_date")))


def facets(incidents: DataFrame) -> DataFrame:
    """(facet, key, n): incidents by category, species, status and month, and in all, in one pass."""
    month = F.date_format("rescue_date", "yyyy-MM")
    rows = incidents.select(F.inline(F.array(*(F.struct(F.lit(n).alias("facet"), c.alias("key")) for n, c in (("category", F.col("category")), ("species", F.col("species")), ("status", F.col("status")), ("month", month), ("total", F.lit("all")))))))
    return rows.groupBy("facet", "key").agg(F.count("*").alias("n"))


def statistics(stored: DataFrame, start: str, end: str, region_id: int | None = None, with_deleted: bool = False, overlap: bool = False) -> DataFrame:
    """Facets of the incidents between two dates that are in yearly snapshots; a snapshot counts if its year lies wholly between them, or, ``overlap``, if any of it does. Deleted
    incidents are left out unless asked for."""
    year = F.year("rescue_date")
    first, last = F.make_date(year, F.lit(1), F.lit(1)), F.make_date(year, F.lit(12), F.lit(31))
    a, b = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    inside = (last >= a) & (first <= b) if overlap else (first >= a) & (last <= b)
    rows = stored.filter(F.col("rescue_date").between(a, b) & inside)
    rows = rows if region_id is None else rows.filter(F.col("region_id") == region_id)
    return facets(rows if with_deleted else rows.filter("deleted_at is null"))


#: Fixed names of a stored incident's fields and the columns that they come from; coordinates are a field of two.
STORED = {"incidentKey": "incident_id", "formId": "form_id", "rescueDate": "rescue_date", "requestId": "request_id", "animalCategory": "category", "animalSpecies": "species", "processStatus": "status", "villageTown": "village", "beatNaka": "beat_naka", "description": "description"}


def product_rows(incidents: DataFrame, snapshots: DataFrame, product_id: int) -> DataFrame:
    """(label, snapshot_id, incident_id, region_id, value): incidents as JSON under their year's snapshot, which is made if it isn't there."""
    from verdure.operators import publish

    wanted = incidents.select(F.lit(product_id).alias("product_id"), "label").distinct()
    ids = publish.get_or_create(wanted, snapshots).select("label", F.col("id").alias("snapshot_id"))
    value = F.to_json(F.struct(*(F.col(c).alias(n) for n, c in STORED.items()), F.struct("latitude", "longitude").alias("coordinates")))
    return incidents.join(ids, "label").select("label", "snapshot_id", "incident_id", "region_id", value.alias("value"))


def store_rows(stored: DataFrame, rows: DataFrame, when: str) -> DataFrame:
    """The table ``stored`` after ``rows`` are stored: one row for each snapshot, region and incidentKey of the JSON. A known one's value and updated_at change and its other columns stay, so
    a deleted one is still deleted; an unknown one is added. Rows of one key in ``rows`` must be one."""
    keyed = lambda df: df.withColumn("key", F.get_json_object("value", "$.incidentKey"))
    old = keyed(stored).withColumnsRenamed({"value": "old_value", "updated_at": "old_at"})
    both = keyed(rows.select("snapshot_id", "region_id", "value")).join(old, ["snapshot_id", "region_id", "key"], "full")
    at = F.to_date(F.lit(when))
    changed = F.col("value").isNotNull()
    new = {"value": F.coalesce("value", "old_value"), "created_at": F.coalesce("created_at", at), "updated_at": F.when(changed, at).otherwise(F.col("old_at"))}
    return both.select(*(new.get(c, F.col(c)).alias(c) for c in stored.columns))

"""Calendar fortnights and their labels: days 1 to 15, and day 16 to the month's end."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SHORT = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
LONG = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]


def fortnight(date: Column) -> Column:
    return F.when(F.dayofmonth(date) <= 15, 1).otherwise(2)


def fortnight_start(date: Column) -> Column:
    first = F.trunc(date, "month")
    return F.when(fortnight(date) == 1, first).otherwise(F.date_add(first, 15))


def fortnight_end(date: Column) -> Column:
    return F.when(fortnight(date) == 1, F.date_add(F.trunc(date, "month"), 14)).otherwise(F.last_day(date))


def month_name(month: Column, long: bool = False) -> Column:
    """English name, whatever the locale."""
    return F.element_at(F.array(*map(F.lit, LONG if long else SHORT)), month)


def band_month(band: Column) -> Column:
    """Month of a fortnight band 1 to 24."""
    return F.floor((band - 1) / 2).cast("int") + 1


def band_fortnight(band: Column) -> Column:
    return F.when(band % 2 == 0, 2).otherwise(1)


def dated_label(product: str, date: Column, long: bool = False) -> Column:
    return F.format_string(f"{product}_%d_%s_fn%d", F.year(date), month_name(F.month(date), long), fortnight(date))


def season(date: Column) -> Column:
    """april_may or november_december of a year; null outside."""
    m = F.month(date)
    return F.when(m.isin(4, 5), F.concat(F.year(date).cast("string"), F.lit("_apr_may"))).when(m.isin(11, 12), F.concat(F.year(date).cast("string"), F.lit("_nov_dec")))

"""Sums that don't depend on their order, and rounding that doesn't depend on a sum's last bits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact(c: Column, places: int = 9) -> Column:
    """``c`` to ``places`` decimal places, up to 27 digits. What isn't a finite number of that size is null."""
    return c.try_cast(f"decimal(27,{places})")


def total(c: Column, places: int = 9) -> Column:
    """Sum in decimals: the same in whatever order rows come."""
    return F.sum(exact(c, places)).cast("double")


def mean(c: Column, places: int = 9) -> Column:
    return total(c, places) / F.count(exact(c, places))


def half_up(c: Column, places: int) -> Column:
    """``c`` rounded to ``places``, halves away from zero. Nine more places are looked at: enough for noise in a sum's last bits not to move a half, and no value that is below one."""
    return F.round(c.try_cast(f"decimal(38,{places + 9})"), places).cast("double")

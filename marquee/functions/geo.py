"""Column expressions on coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cell(c: Column) -> Column:
    """Whole-degree cell, halves to even."""
    return F.bround(c).cast("int")


def coarse_country(lat: Column, lng: Column) -> Column:
    """Country from a coordinate alone, blank where both are near."""
    alaska = (lat >= 51.0) & (lng <= -130.0)
    return (
        F.when(lat.isNull() | lng.isNull(), "").when(alaska, "US").when(lat >= 49.5, "CA").when((lat >= 45.0) & (lng >= -95.0), "")
        .when((lat >= 24.0) & (lat < 49.5), "US").otherwise("")
    )

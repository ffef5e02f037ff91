"""Column expressions on run dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip


def iso_day(c: Column) -> Column:
    """Date of a ``YYYY-M-D`` text; null for anything else."""
    v = strip(c)
    return F.when(v.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(v, "yyyy-M-d"))


def day_first(c: Column) -> Column:
    """Date of a ``D/M/YYYY`` text; null for anything else."""
    v = strip(c)
    return F.when(v.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(v, "d/M/yyyy"))


def run_days(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def run_kind(start: Column, end: Column) -> Column:
    """What a pair of dates stands for, from its length in days."""
    d = run_days(start, end)
    return F.when(d.isNull(), "unknown").when(d < 0, "invalid").when(d <= 14, "performance run").when(d <= 120, "extended run").otherwise("license window")


def open_range(start: Column, end: Column) -> Column:
    """Struct ``start, end`` of texts like ``Feb 20`` and ``Mar 14, 2027`` or ``23, 2026``.

    Only the end has a year; the start is in the year before where its month is the later one.
    Without a readable end both are null; without a readable start only the end is set.
    """
    end_at, start_at = r"^\s*(?:([A-Za-z]{3})[a-z]*\.?\s+)?(\d{1,2}),\s*(\d{4})\s*$", r"^\s*([A-Za-z]{3})[a-z]*\.?\s+(\d{1,2})\s*$"
    part = lambda c, p, i: F.regexp_extract(F.coalesce(c, F.lit("")), p, i)
    make = lambda m, d, y: F.try_to_date(F.concat_ws(" ", F.initcap(m), d, y), "MMM d yyyy")
    month = lambda m: F.month(make(m, F.lit("1"), F.lit("2000")))
    sm, sd, em, ed, ey = part(start, start_at, 1), part(start, start_at, 2), part(end, end_at, 1), part(end, end_at, 2), part(end, end_at, 3)
    em = F.when(em == "", sm).otherwise(em)
    last = make(em, ed, ey)
    year = ey.try_cast("int")
    first = make(sm, sd, F.when(month(em) < month(sm), year - 1).otherwise(year).cast("string"))
    return F.struct(F.when(last.isNotNull(), first).alias("start"), last.alias("end"))

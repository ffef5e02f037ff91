"""Continuous periods and gaps of day intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Days per leaf (64) and per inner node (4096) of the reduction tree, as shifts.
TREE_SHIFTS = (6, 12)


#: Finished stretches that a merge gathers before it sets them aside.
PAGE = 128


def _linear_merge(runs: Column) -> Column:
    """Fold a start-sorted array of ``(s, e)`` into disjoint stretches; touching days join.

    Finished stretches gather in a page of bounded size and pages in a list, so that no step copies
    what is done: the time is linear in the runs.
    """
    element = "struct<s:int,e:int>"
    start = F.struct(
        F.expr(f"cast(array() as array<array<{element}>>)").alias("pages"), F.expr(f"cast(array() as array<{element}>)").alias("page"),
        F.expr(f"cast(null as {element})").alias("cur"),
    )

    def step(acc: Column, x: Column) -> Column:
        pages, page, cur = acc["pages"], acc["page"], acc["cur"]
        joined = F.struct(cur["s"].alias("s"), F.greatest(cur["e"], x["e"]).alias("e"))
        full = F.size(page) >= PAGE
        return (
            F.when(cur.isNull(), F.struct(pages.alias("pages"), page.alias("page"), x.alias("cur")))
            .when(x["s"] <= cur["e"] + 1, F.struct(pages.alias("pages"), page.alias("page"), joined.alias("cur")))
            .when(full, F.struct(F.concat(pages, F.array(page)).alias("pages"), F.array(cur).alias("page"), x.alias("cur")))
            .otherwise(F.struct(pages.alias("pages"), F.concat(page, F.array(cur)).alias("page"), x.alias("cur")))
        )

    return F.aggregate(runs, start, step, lambda acc: F.flatten(F.concat(acc["pages"], F.array(F.concat(acc["page"], F.array(acc["cur"]))))))


def disjoint_stretches(
    df: DataFrame, key: str, start: str, end: str, *, min_rows: int = 1
) -> DataFrame:
    """One row per ``key``: ``rows`` and ``stretches``, its sorted disjoint intervals.

    The aggregate is mergeable. Rows first collapse per (key, start day) to their latest end,
    which combines map-side and spreads a hot key over its start days. Leaves hold the
    disjoint list of 64 start days, inner nodes merge the lists of 4,096 days, the root merges
    those: no task ever holds more than one sorted list per day span, whatever the number of
    rows of a key. Array sorting of concatenated sorted lists is a run-merging sort, so a node
    is a linear merge of its children.

    Rows that lack a key, a start or an end, and rows that end before they start, are left
    out and do not count for ``min_rows``. Repeated rows count each. Empty input gives no rows.
    """
    days = lambda c: F.datediff(F.col(c).cast("date"), F.lit("1970-01-01").cast("date"))
    level = (
        df.select(F.col(key).alias("k"), days(start).alias("s"), days(end).alias("e"))
        .filter(F.col("k").isNotNull() & (F.col("e") >= F.col("s")))
        .groupBy("k", "s")
        .agg(F.max("e").alias("e"), F.count(F.lit(1)).alias("n"))
    )
    level = level.select(
        "k", F.col("s").alias("at"), F.array(F.struct("s", "e")).alias("runs"), "n"
    )
    for shift in (*TREE_SHIFTS, None):
        node = F.lit(0) if shift is None else F.shiftright("at", shift)
        if shift is not None:
            level = level.withColumn("node", node)
            keys = ["k", "node"]
        else:
            keys = ["k"]
        level = level.groupBy(*keys).agg(
            F.min("at").alias("at"),
            _linear_merge(F.array_sort(F.flatten(F.collect_list("runs")))).alias("runs"),
            F.sum("n").alias("n"),
        )
    return level.filter(F.col("n") >= min_rows).select(
        F.col("k").alias(key), F.col("n").alias("rows"), F.col("runs").alias("stretches")
    )


def periods_and_gaps(
    df: DataFrame, key: str, start: str, end: str, *, min_rows: int = 1
) -> DataFrame:
    """``key, kind, from_day, to_day``: the stretches of each key and the free days between.

    ``kind`` is ``period`` or ``gap``; a gap runs from the first to the last free day. Null and
    reversed rows: see :func:`disjoint_stretches`. Other columns of ``df`` are ignored, also
    ones named like the result's.
    """
    lists = disjoint_stretches(df, key, start, end, min_rows=min_rows)
    piece = lambda kind, a, b: F.struct(F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"))
    runs = F.col("stretches")
    spans = F.transform(runs, lambda r: piece("period", r["s"], r["e"]))
    holes = F.transform(
        F.arrays_zip(
            F.slice(runs, F.lit(1), F.size(runs) - 1).alias("x"),
            F.slice(runs, F.lit(2), F.size(runs) - 1).alias("y"),
        ),
        lambda p: piece("gap", p["x"]["e"] + 1, p["y"]["s"] - 1),
    )
    day = lambda c: F.date_format(F.date_from_unix_date(c), "yyyy-MM-dd")
    return lists.select(
        F.col(key).alias("key"), F.explode(F.concat(spans, holes)).alias("p")
    ).select("key", "p.kind", day(F.col("p.a")).alias("from_day"), day(F.col("p.b")).alias("to_day"))

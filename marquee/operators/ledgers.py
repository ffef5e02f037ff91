"""Day-over-day ledgers: first and last rows, news, freshness and upserts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import run_kind

# Days for which a contact status stays valid.
STATUS_DAYS = {"found": 365, "error": 7}
OTHER_DAYS = 90


def first_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The earliest row of each key; an aggregate that combines map-side, not a window over a hot key."""
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*others), order).alias("_r")).select(*keys, "_r.*").select(*df.columns)


def last_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The latest row of each key."""
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_r")).select(*keys, "_r.*").select(*df.columns)


def seen_diff(current: DataFrame, seen: DataFrame, today: date) -> DataFrame:
    """``key, first_seen, last_seen, is_new`` of the distinct keys of ``current``.

    A key is new if the ledger lacks it; a blank ledger day is kept as it is. A key that is
    repeated in the ledger has its earliest non-blank day.
    """
    ledger = seen.groupBy("key").agg(F.coalesce(F.min(F.when(F.col("first_seen") != "", F.col("first_seen"))), F.lit("")).alias("known"))
    day = F.lit(today.isoformat())
    keys = current.select("key").filter(F.col("key").isNotNull()).distinct()
    return keys.join(ledger, "key", "left").select("key", F.coalesce("known", day).alias("first_seen"), day.alias("last_seen"), F.col("known").isNull().alias("is_new"))


def is_fresh(status: Column, checked: Column, today: date, *, manual: Column | None = None, refresh_found: bool = False) -> Column:
    """Whether a kept contact may be used again: by hand, found for good, or young enough for its status."""
    lasting = F.lit(False) if refresh_found else status.isin("found", "no_website")
    days = F.lit(OTHER_DAYS)
    for name, n in STATUS_DAYS.items():
        days = F.when(status == name, n).otherwise(days)
    when = F.when(checked.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(checked, "yyyy-M-d"))
    young = F.coalesce(F.datediff(F.lit(today), when) < days, F.lit(False))
    return F.coalesce(manual, F.lit(False)) | F.coalesce(lasting, F.lit(False)) | young if manual is not None else F.coalesce(lasting, F.lit(False)) | young


def upsert(ledger: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The ledger with rows of ``changes`` in place of, or beside, its own; one row per key in each."""
    kept = ledger.join(changes.select(key), key, "left_anti")
    return kept.unionByName(changes, allowMissingColumns=True)


def merged_counts(kept: DataFrame, fresh: DataFrame, key: str, count: str) -> DataFrame:
    """Full outer merge: known rows keep their columns and take the new count, new keys are added."""
    new = fresh.select(F.col(key), F.col(count).alias("_n"))
    return kept.join(new, key, "full").withColumn(count, F.coalesce("_n", count)).drop("_n")


def next_per_key(rows: DataFrame, key: str, today: date) -> DataFrame:
    """Of each key the row that starts soonest from today on, licence windows apart; equal days go to the smaller ``key``."""
    start, end = F.col("start_date"), F.col("end_date")
    coming = rows.filter((start >= F.lit(today)) & (run_kind(start, end) != "license window"))
    return coming.groupBy(key).agg(F.min_by(F.struct(*[c for c in rows.columns if c != key]), F.struct("start_date", "key")).alias("_r")).select(key, "_r.*")


def winner_per_key(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key by ``order``, as an aggregate that combines map-side; null keys have none."""
    others = [c for c in rows.columns if c != key]
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_r")).select(key, "_r.*")


def absent_keys(ledger: DataFrame, live: DataFrame, key: str) -> DataFrame:
    """Rows of the ledger whose key is not among the live ones."""
    return ledger.join(live.select(key).distinct(), key, "left_anti")


def capped(rows: DataFrame, order: list[Column | str], cap: int) -> DataFrame:
    """``rows`` with ``within``: whether a row is among the first ``cap`` by ``order``; a negative cap holds none back.

    The border row is found by a top-k, so no window runs over all rows; ``order`` must be without ties.
    """
    if cap < 0:
        return rows.withColumn("within", F.lit(True))
    border = rows.select(F.struct(*order).alias("o")).orderBy("o").limit(cap).agg(F.max("o").alias("_border"))  # one row
    return rows.join(F.broadcast(border)).withColumn("within", F.coalesce(F.struct(*order) <= F.col("_border"), F.lit(False))).drop("_border")


def load_ledger(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The newest whole version of a ledger saved by :func:`save_ledger`; an empty table where there is none."""
    versions = _versions(spark, folder)
    return spark.read.schema(schema).parquet(versions[-1]) if versions else spark.createDataFrame([], schema)


def save_ledger(rows: DataFrame, folder: str, *order: str) -> str:
    """Write a new version beside the old ones, which a reader of them may still be reading; rows sorted by ``order``."""
    spark = rows.sparkSession
    number = int(_versions(spark, folder)[-1].rsplit("-", 1)[1]) + 1 if _versions(spark, folder) else 0
    path = f"{folder}/version-{number:08d}"
    (rows.orderBy(*order) if order else rows).write.mode("overwrite").parquet(path)
    return path


def _versions(spark: SparkSession, folder: str) -> list[str]:
    """Folders of whole versions, oldest first."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath().toString() for s in fs.listStatus(path(folder))] if fs.exists(path(folder)) else []
    return sorted(f for f in found if "/version-" in f and fs.exists(path(f"{f}/_SUCCESS")))

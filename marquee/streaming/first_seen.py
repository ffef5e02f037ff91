"""First sighting of each key on a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir


def first_sightings(events: DataFrame, key: str, at: str) -> DataFrame:
    """Streaming ``key, first_seen``: the running minimum of ``at`` per key, in update mode.

    A key's state is one timestamp. Keys never expire, as a ledger's do not, so no watermark is
    set; an event that comes late still lowers its key's first sighting.
    """
    return events.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.min(at).alias("first_seen"))


def windowed_counts(events: DataFrame, at: str, width: str, late: str) -> DataFrame:
    """Streaming counts per window of event time; windows close ``late`` after the newest event."""
    return events.withWatermark(at, late).groupBy(F.window(at, width).alias("w")).agg(F.count(F.lit(1)).alias("events")).select("w.start", "w.end", "events")


def ledger_of_files(spark: SparkSession, path: str, schema, key: str, at: str) -> DataFrame:
    """Run :func:`first_sightings` over the files of ``path`` once and return the ledger it wrote."""
    folder = work_dir(spark)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 8).parquet(path)

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/ledger/batch={number}")

    query = first_sightings(stream, key, at).writeStream.outputMode("update").option("checkpointLocation", f"{folder}/state").foreachBatch(save).trigger(availableNow=True).start()
    query.awaitTermination()
    ledger = spark.read.parquet(f"{folder}/ledger")
    return ledger.groupBy("key").agg(F.min("first_seen").alias("first_seen"))

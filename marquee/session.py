"""Session helpers: the shared work folder, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes in memory up to which a side may be broadcast; beyond it the join shuffles.
BROADCAST_LIMIT = 8 << 20
#: Bytes that a row of a hashed relation takes beside its values.
ROW_BYTES = 48
#: Runs of a ledger's level that are merged into one of the next.
FAN = 8


@cache
def _local_dir() -> str:
    return "file://" + tempfile.mkdtemp(prefix="marquee-")


def work_dir(spark: SparkSession) -> str:
    """Fresh subfolder of the folder that all executors share, from ``spark.checkpoint.dir``.

    Only on a local master, where that setting is absent (unit tests), a local folder is made; on a
    cluster its absence is an error, as no machine-local folder would do. The subfolder
    is removed when the JVM ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_dir()
    path = f"{base.rstrip('/')}/marquee-{uuid.uuid4().hex}"
    fs, target = _file_system(spark, path)
    fs.mkdirs(target)
    fs.deleteOnExit(target)
    return path


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def bytes_in_memory(df: DataFrame) -> Column:
    """Aggregate: what the rows of ``df`` take as a hashed relation, from counted rows and measured texts."""
    size = F.count(F.lit(1)) * (ROW_BYTES + 8 * len(df.columns))
    for f in df.schema.fields:
        if not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)):
            size = size + F.coalesce(F.sum(F.octet_length(F.col(f"`{f.name}`").cast("string"))), F.lit(0))
    return size


def written(df: DataFrame, folder: str, name: str, *partition: str, measured: bool = False) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet into the shared folder and read it back.

    The table survives the loss of any executor, unlike cached or local-checkpoint blocks. With
    ``measured`` its size in memory is taken while it is written, for :func:`small`.
    """
    path = f"{folder}/{name}-{uuid.uuid4().hex[:8]}"
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows"), bytes_in_memory(df).alias("size")) if measured else df
    writer = rows.write.mode("errorifexists")
    if partition:
        writer = writer.partitionBy(*partition)
    writer.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.path = path
    if measured:
        table.measured = seen.get["size"] or 0
        table.counted = seen.get["rows"] or 0
    return table


def drop_written(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`written` once nothing reads it any more."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def release_driver_memory(spark: SparkSession) -> bool:
    """Let the driver collect its garbage and give free native memory back to the system.

    Plans, broadcasts and shuffle files go only when the driver collects its garbage; left to itself its heap
    grows to the limit first. What the JVM freed beside the heap (compiler and network buffers of many plans) is kept by
    the C library unless it is asked to trim; a JVM without that command, or a driver that may not ask, just keeps it (false).
    """
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    jvm.System.gc()
    try:
        # the server's own class is closed to callers, its interface is not
        call = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        told = gateway.new_array(jvm.Object, 4)
        told[0], told[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        told[2], told[3] = gateway.new_array(jvm.Object, 0), gateway.new_array(jvm.String, 0)
        call.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), told)
    except Py4JError:
        return False
    return True


def small(df: DataFrame, of: DataFrame | None = None, *, size: int | None = None, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``df`` with a broadcast hint if it is proven to take at most ``limit`` bytes in memory, else with one against it.

    Proof is the measure of the written table that ``df`` is, or is a part ``of``, or a counted
    ``size``. The optimizer's own estimates are the file's compressed bytes and prove nothing, so
    a side without a proof is never broadcast.
    """
    if size is None:
        size = getattr(df if of is None else of, "measured", None)
    return F.broadcast(df) if size is not None and size <= limit else apart(df)


def apart(df: DataFrame) -> DataFrame:
    """``df`` with a hint that its join shuffles both sides, whatever the optimizer guesses of its size."""
    return df.hint("merge")


class Ledger:
    """A table in the shared folder that batches are appended to, kept as sorted runs.

    ``kind`` parts it into folders, so a reader of one kind lists and reads no other. Rows of a run
    are sorted by ``order``, so that a filter on its first column skips row groups. When ``FAN``
    runs of a level have gathered they are merged into one of the next level: a row is rewritten a
    number of times that grows with the logarithm of the number of batches, and a reader opens few files.
    Runs found in the folder are taken up again, so a ledger outlives its session; a merge that was
    cut short leaves rows twice, which its readers must bear.
    """

    def __init__(self, spark: SparkSession, folder: str, name: str, schema: str, order: tuple[str, ...]):
        self.spark, self.path, self.order = spark, f"{folder}/{name}", order
        self.schema = spark.createDataFrame([], f"{schema}, kind string").schema
        self.levels: list[list[str]] = [[]]
        fs, target = _file_system(spark, self.path)
        for run in sorted(str(s.getPath().toString()) for s in fs.listStatus(target)) if fs.exists(target) else []:
            level = int(run.rsplit("run=", 1)[1].split("-")[0])
            if fs.exists(_file_system(spark, f"{run}/_SUCCESS")[1]):
                self.levels += [[] for _ in range(level + 1 - len(self.levels))]
                self.levels[level].append(run)

    def append(self, rows: DataFrame) -> None:
        """Write ``rows``, with the ledger's columns, as a run of the lowest level."""
        self.levels[0].append(self._run(rows, 0))
        for level, runs in enumerate(self.levels):
            if len(runs) < FAN:
                break
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._run(self._of(runs), level + 1))
            self.levels[level] = []
            for run in runs:
                drop_written(self.spark, run)

    def _run(self, rows: DataFrame, level: int) -> str:
        path = f"{self.path}/run={level}-{uuid.uuid4().hex[:12]}"
        spread = rows.select(*self.schema.names).repartition("kind", self.order[0]).sortWithinPartitions("kind", *self.order)
        spread.write.partitionBy("kind").parquet(path)
        return path

    def _of(self, runs: list[str]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*runs).select(*self.schema.names)

    def read(self, kind: str) -> DataFrame:
        return self._of([run for runs in self.levels for run in runs]).filter(F.col("kind") == kind).drop("kind")

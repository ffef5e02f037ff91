import pytest
from pyspark.sql import functions as F

from marquee import session


def rows(spark, *some):
    return spark.createDataFrame([(i, str(i), k) for i, k in some], "n int, t string, kind string")


def test_ledger_merges_runs_and_goes_on(spark):
    folder = session.work_dir(spark)
    ledger = session.Ledger(spark, folder, "l", "n int, t string", ("n",))
    assert ledger.read("a").count() == 0
    for i in range(session.FAN + 1):
        ledger.append(rows(spark, (i, "a"), (100 + i, "b")))
    assert [len(runs) for runs in ledger.levels] == [1, 1]
    again = session.Ledger(spark, folder, "l", "n int, t string", ("n",))
    assert [len(runs) for runs in again.levels] == [1, 1]
    again.append(rows(spark, (50, "a")).limit(0))
    assert sorted(r.n for r in again.read("a").collect()) == list(range(session.FAN + 1))
    assert sorted(r.n for r in again.read("b").collect()) == [100 + i for i in range(session.FAN + 1)]
    assert again.read("c").count() == 0


def test_only_proven_sides_are_broadcast(spark):
    folder = session.work_dir(spark)
    table = session.written(rows(spark, (1, "a"), (2, "b")), folder, "t", measured=True)
    assert table.counted == 2 and 2 * session.ROW_BYTES < table.measured < 1000
    left = spark.range(10).withColumn("n", F.col("id").cast("int"))
    plan = lambda side: left.join(side, "n")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(session.small(table)) and "broadcast" in plan(session.small(table.select("n"), table))
    assert "merge" in plan(session.small(table, limit=10)) and "merge" in plan(session.small(rows(spark, (1, "a")))) and "merge" in plan(session.small(table, size=1 << 30))


def test_work_dir_demands_a_shared_folder(spark):
    class Cluster:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

            @staticmethod
            def getConf():
                return Cluster.conf

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_dir(Cluster)


def test_driver_memory_is_given_back(spark):
    assert session.release_driver_memory(spark)

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from opinara import staging
from opinara.staging import stage


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle")}


def test_staging_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = spark.range(1000).select((F.col("id") % 97).alias("k"), "id")
    staged = stage(rows.groupBy("k").agg(F.sum("id").alias("n")).repartition(3, "n"), "sums")
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert staged.agg(F.sum("n")).first()[0] == 999 * 500


def test_sessions_keep_their_shuffle_setting(spark):
    def found(value):
        return spark.conf.get(staging.DROP_SHUFFLES, None) == value

    unset = spark.conf.get(staging.DROP_SHUFFLES, None)
    with ThreadPoolExecutor(4) as threads:
        assert all(t.count() == 10 for t in threads.map(lambda n: stage(spark.range(10).repartition(2), f"t{n}"), range(8)))
    assert found(unset) and not staging._DROPPING
    for kept in ("true", "false"):
        spark.conf.set(staging.DROP_SHUFFLES, kept)
        with staging.dropped_shuffles(spark), staging.dropped_shuffles(spark):
            assert found("true")
        assert found(kept)
    spark.conf.unset(staging.DROP_SHUFFLES)


def test_an_aggregate_staged_twice_has_its_rows_each_time(spark):
    sums = spark.range(100).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n"))
    assert sums.count() == stage(sums, "a").count() == stage(sums, "b").count() == sums.count() == 7

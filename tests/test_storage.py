from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from minekit.functions import storage


def session(master, setting=None, active=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: active)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting or default), sparkContext=context)


def test_the_shared_folder_comes_from_the_session():
    assert storage.work_dir(session("spark://host", setting="hdfs:///shared")) == "hdfs:///shared"
    assert storage.work_dir(session("spark://host", active="hdfs:///set")) == "hdfs:///set"


def test_a_cluster_never_uses_a_folder_of_one_machine():
    with pytest.raises(RuntimeError):
        storage.work_dir(session("yarn"))


def test_settle_stores_under_the_shared_folder(spark):
    df = spark.range(10).select("id", (F.col("id") / 3).alias("x"))
    kept = storage.settle(df, "numbers")
    assert kept.schema == df.schema or kept.dtypes == df.dtypes
    assert kept.exceptAll(df).isEmpty() and kept.count() == 10
    folder = spark.conf.get("spark.checkpoint.dir")
    assert all(folder in name for name in kept.inputFiles())


def test_only_small_inputs_are_dealt_out(spark, monkeypatch):
    small = storage.settle(spark.range(100).coalesce(1), "small")
    assert storage.spread(small).select(F.spark_partition_id()).distinct().count() == 8
    monkeypatch.setattr(storage, "SMALL_INPUT", 1)
    assert storage.spread(small).select(F.spark_partition_id()).distinct().count() == 1


def test_ranges_grow_with_the_size_of_the_data(spark, monkeypatch):
    from minekit.functions.ranking import RANGE_BYTES, chunked, dense_index

    df = spark.range(3000).withColumn("x", F.col("id") * 7 % 3000)
    for ranges in (8, 40):
        monkeypatch.setattr(storage, "estimated_bytes", lambda _, n=ranges: n * RANGE_BYTES)
        assert chunked(df, ["x"], "ranges").select("_chunk").distinct().count() == ranges
        assert dense_index(df, "x", "at").where("at <> x").isEmpty()

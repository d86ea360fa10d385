from pyspark.sql import functions as F

from lading.llm import narrow


def test_every_key_is_flagged_and_few_others(spark):
    rows = spark.range(0, 20_000, 1, 4).select((F.col("id") * 7 - 5_000).alias("k"), F.spark_partition_id().alias("part"))
    keys = rows.where("k % 11 = 0").select("k").union(rows.where("k = 0").select("k"))
    got = narrow.may_match(rows, "k", keys, "may")
    assert got.columns == ["k", "part", "may"] and got.count() == 20_000
    assert got.where("k % 11 = 0 and not may").isEmpty() and got.where("may is null").isEmpty()
    assert got.where("k % 11 <> 0 and may").count() < 20
    assert got.where(F.col("part") != F.spark_partition_id()).isEmpty()


def test_more_keys_than_bits(spark, monkeypatch):
    """What is broadcast stays bounded; no key is lost."""
    monkeypatch.setattr(narrow, "SLOTS", 1 << 8)
    rows = spark.range(2_000).select("id")
    got = narrow.may_match(rows, "id", rows.where("id < 1000"), "may")
    assert got.where("id < 1000 and not may").isEmpty() and got.count() == 2_000


def test_no_keys_and_null_values(spark):
    rows = spark.createDataFrame([(1,), (None,)], "k long")
    got = narrow.may_match(rows, "k", rows.where("k = 9"), "may").collect()
    assert [r.may for r in got] == [False, False]

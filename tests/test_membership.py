from pyspark.sql import functions as F

from staylift.operators.membership import bloom


def test_no_key_is_missed_and_few_others_pass(spark):
    keys = spark.range(0, 4000, 2).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    some = bloom(keys, "key", bits=1 << 16)
    asked = spark.range(0, 20_000).select("id", F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    passed = {r.id for r in asked.filter(some.may_hold(F.col("key"))).collect()}
    assert set(range(0, 4000, 2)) <= passed and len(passed) < 2000 + 200


def test_a_small_filter_only_lets_more_through(spark):
    keys = spark.range(1000).withColumnRenamed("id", "key")
    small = bloom(keys, "key", bits=128)
    assert keys.filter(small.may_hold(F.col("key"))).count() == 1000
    nothing = bloom(keys.limit(0), "key", bits=128)
    assert keys.filter(nothing.may_hold(F.col("key"))).count() == 0


def test_the_test_needs_no_exchange(spark):
    some = bloom(spark.range(10).withColumnRenamed("id", "key"), "key", bits=1 << 10)
    rows = spark.range(1000).filter(some.may_hold(F.col("id")))
    plan = rows._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert "Exchange" not in plan and "Join" not in plan and rows.count() >= 10


def test_bits_follow_the_keys(spark):
    keys = spark.range(5000).withColumnRenamed("id", "key")
    some = bloom(keys, "key")
    assert some.bits == 1 << 17 and bloom(keys.limit(0), "key").bits == 1 << 12
    assert keys.filter(some.may_hold(F.col("key"))).count() == 5000
    assert spark.range(10_000, 20_000).filter(some.may_hold(F.col("id"))).count() < 300

import pytest
from pyspark.sql import functions as F

from bankmart.operators.joins import hot_keys, lookup
from bankmart.sources import stage
from tests.frames import rows


def skewed(spark, n=3000):
    """A third of all rows share one key, some rows are full copies, some keys are NULL."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 400)
    return spark.range(n).select(key.cast("int").alias("k"), (F.col("id") % 5).alias("v"))


def dimension(spark):
    return spark.range(0, 400, 3).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("name"))


def expected(left, right, how):
    return sorted(rows(left.join(right, "k", how).select("k", "v", "name")), key=repr)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("share", [2, 4, 1000])
def test_lookup_equals_plain_join(spark, how, share):
    left, right = skewed(spark), dimension(spark)
    got = lookup(left, right, ["k"], how, share=share)
    assert sorted(rows(got), key=repr) == expected(left, right, how)


def test_lookup_of_repeated_right_keys(spark):
    left, right = skewed(spark), dimension(spark)
    twice = right.unionAll(right.where("k % 2 = 1").withColumn("name", F.col("name") + 1))
    assert sorted(rows(lookup(left, twice, ["k"], share=4)), key=repr) == expected(left, twice, "left")


def test_hot_key_is_found_and_spread(spark):
    left, right = skewed(spark), dimension(spark).unionAll(spark.createDataFrame([(7, 70)], "k int, name long"))
    assert rows(hot_keys(left, ["k"], share=4)) == [(7, 2)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup(left, right, ["k"], share=16)
        sizes = joined.where("k = 7").groupBy(F.spark_partition_id()).count()
        assert sizes.count() > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_only_rows_that_are_cut_are_hashed(spark):
    """The salt of a wide row with a common key costs no hash of its columns."""
    plan = lookup(skewed(spark), dimension(spark), ["k"], share=4)._jdf.queryExecution().optimizedPlan().toString()
    salts = [line for line in plan.splitlines() if "AS _salt" in line and "xxhash64" in line]
    assert salts and all("ELSE 0 END AS _salt" in line for line in salts)


def test_number_of_hot_keys_is_bounded(spark):
    even = spark.range(1000).select((F.col("id") % 10).alias("k"))
    assert hot_keys(even, ["k"], share=10).count() == 0
    found = rows(hot_keys(even, ["k"], share=11))
    assert len(found) == 10 and sum(r[1] for r in found) < 2 * 11


def test_hot_keys_found_once_serve_several_keys(spark):
    left = skewed(spark).withColumn("w", F.when(F.col("v") > 0, F.col("v") % 2))
    right = dimension(spark).crossJoin(spark.range(2).select(F.col("id").alias("w")))
    hot = hot_keys(left, ["k"], share=16)
    got = lookup(left, right, ["k", "w"], hot=hot)
    want = left.join(right, ["k", "w"], "left").select(*got.columns)
    assert sorted(rows(got), key=repr) == sorted(rows(want), key=repr)
    assert rows(hot)[0][0] == 7


def test_hot_keys_read_the_table_once(spark):
    left = stage(skewed(spark), "hot-probe")
    found = hot_keys(left, ["k"], share=4)
    found.collect()
    assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()

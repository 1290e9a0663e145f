from pyspark.sql import functions as F

from areatab.operators.skew import hot_keys, salted_join


def test_salted_join_equals_plain_and_spreads_hot_key(spark):
    # one parent owns a third of all children
    big = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000 + 1000).alias("k"), F.col("id").alias("child")
    )
    small = spark.range(0, 2000).select((F.col("id") + 0).alias("k"), F.concat(F.lit("a"), F.col("id").cast("string")).alias("area"))
    small = small.filter("k = 7 OR k >= 1000")
    plain = big.join(small, "k", "inner")
    salted = salted_join(big, small, "k", "inner", hot_rows=1000, salts=16)
    assert sorted(map(tuple, salted.select("k", "child", "area").collect())) == sorted(map(tuple, plain.select("k", "child", "area").collect()))
    assert {r[0] for r in hot_keys(big, "k", 1000).collect()} == {7}
    # the hot key's rows land in many tasks, not one (observe raw hash
    # placement: no coalescing of this tiny shuffle, no broadcast)
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        hot_only = salted_join(big, small, "k", "inner", hot_rows=1000, salts=16).filter("k = 7")
        spread = hot_only.select(F.spark_partition_id().alias("p")).distinct().count()
        plain_spread = big.join(small, "k").filter("k = 7").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert plain_spread == 1 and spread > 4
    left = salted_join(big, small.filter("k <> 7"), "k", "left", hot_rows=1000, salts=16)
    assert left.count() == big.count() and left.filter("k = 7 AND area IS NULL").count() == 10000


def test_identical_hot_rows_use_most_salts(spark, tmp_dir):
    # coarse microdata: one parent, and all its children alike
    path = f"{tmp_dir}/children"
    spark.range(0, 15000, 1, 4).select(F.lit(7).alias("k"), F.lit("same").alias("v")).write.parquet(path)
    big = spark.read.parquet(path)
    small = spark.createDataFrame([(7, "a")], "k int, area string")
    joined = salted_join(big, small, "k", "inner", hot_rows=1000, salts=64)
    assert joined.count() == 15000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "row_index" in plan
    from areatab.operators.skew import row_identity

    salts = big.select(F.pmod(row_identity(big), F.lit(64)).alias("s")).distinct().count()
    assert salts >= 60


def test_keyless_rows_are_spread_and_kept(spark):
    big = spark.range(0, 4000).select(F.when(F.col("id") % 2 == 0, F.lit(1)).alias("k"), F.col("id").alias("child"))
    small = spark.createDataFrame([(1, "a")], "k int, area string")
    left = salted_join(big, small, "k", "left", hot_rows=100, salts=16, identity=["child"])
    assert left.count() == 4000 and left.where("area is null").count() == 2000
    assert salted_join(big, small, "k", "inner", hot_rows=100, salts=16, identity=["child"]).count() == 2000

from pyspark.sql import Window
from pyspark.sql import functions as F

from reelspark.operators.spread import (
    dense_rank_within,
    lookup_join,
    rank_within,
    sorted_positions,
    top_per_key,
)


def skewed(spark):
    """A third of the rows share one group; values repeat."""
    return spark.range(999).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 17)).alias("g"),
        (F.col("id") * 37 % 101).alias("v"),
        "id",
    )


def test_positions_are_dense_and_ordered(spark):
    got = sorted_positions(skewed(spark), [F.desc("v"), F.col("id")], "p").orderBy("p").collect()
    assert [r.p for r in got] == list(range(999))
    assert [(-r.v, r.id) for r in got] == sorted((-r.v, r.id) for r in got)


def test_ranks_equal_window_ranks(spark):
    df = skewed(spark).cache()
    group = Window.partitionBy("g")
    want = df.withColumn("r", F.row_number().over(group.orderBy(F.desc("v"), "id")))
    got = rank_within(df, "g", [F.desc("v"), F.col("id")], "r")
    assert {tuple(x) for x in got.select("id", "r").collect()} == {
        tuple(x) for x in want.select("id", "r").collect()
    }
    want = df.withColumn("r", F.dense_rank().over(group.orderBy(F.desc("v"))))
    got = dense_rank_within(df, "g", "v", "r")
    assert {tuple(x) for x in got.select("id", "r").collect()} == {
        tuple(x) for x in want.select("id", "r").collect()
    }


def test_null_groups_are_ranked(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", 2)], "g string, v int")
    got = {(r.g, r.v): r.r for r in dense_rank_within(df, "g", "v", "r").collect()}
    assert got == {(None, 3): 1, (None, 1): 2, ("a", 2): 1}


def test_hot_lookup_is_split(spark, tmp_path):
    """With broadcasts off, AQE splits the partition of the hot key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        left = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50_000).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("x"),
        )
        right = left.groupBy("k").agg(F.count("*").alias("n"))
        joined = lookup_join(left, right, ["k"])
        joined.write.mode("overwrite").parquet(str(tmp_path / "out"))
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_top_per_key_trims_before_the_shuffle(spark):
    df = top_per_key(skewed(spark), "g", [F.desc("v"), F.col("id")], 3, "r")
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()
    assert df.where("g = 'hot'").count() == 3

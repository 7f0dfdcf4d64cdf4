from pyspark.sql import Window
from pyspark.sql import functions as F

from perfkit.operators.ranking import rank_within


def test_rank_within_matches_row_number_with_hot_key(spark):
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string")))
        .alias("key"), F.col("id").alias("v"), (F.col("id") * 7919 % 1000).alias("w")).repartition(16)
    got = rank_within(df, "key", [F.col("w"), F.col("v")], "r")
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy("w", "v")))
    assert got.select("key", "v", "r").exceptAll(want.select("key", "v", "r")).count() == 0
    assert got.count() == n
    hot_parts = got.where("key = 'hot'").select(F.spark_partition_id()).distinct().count()
    assert hot_parts >= 1

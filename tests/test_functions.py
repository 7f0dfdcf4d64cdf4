import numpy as np
from pyspark.sql import functions as F

from perfkit.functions.vectors import dot, l2_normalize, sq_norm


def test_vector_expressions(spark):
    a, b = [3.0, 4.0, 0.0], [1.0, 2.0, 2.0]
    df = spark.createDataFrame([(a, b), ([0.0, 0.0, 0.0], b)], "a array<float>, b array<float>")
    r = df.select(dot(F.col("a"), F.col("b")).alias("d"), sq_norm(F.col("a")).alias("n"),
                  l2_normalize(F.col("a")).alias("u")).collect()
    assert r[0]["d"] == float(np.dot(a, b)) and r[0]["n"] == 25.0
    assert r[0]["u"] == [0.6, 0.8, 0.0]
    assert r[1]["u"] == [0.0, 0.0, 0.0]        # zero vector stays zero (N14)

import json

from pyspark.sql import functions as F

from perfkit.functions.number_text import fixed, json_map, json_number


def test_fixed(spark):
    cases = [(0.0, 0, "0"), (0.5, 0, "1"), (2.5, 0, "3"), (0.125, 2, "0.13"), (1.005, 2, "1.01"), (9.999, 2, "10.00"),
             (1234567.25, 1, "1234567.3"), (-0.5, 0, "-1"), (-0.004, 2, "0.00"), (8.9e12, 0, "8900000000000"),
             (1e20, 2, "100000000000000000000.00"), (-1e15, 0, "-1000000000000000"), (None, 2, None)]
    for x, d, want in cases:
        got = spark.range(1).select(fixed(F.lit(x).cast("double"), d).alias("t")).first()["t"]
        assert got == want, (x, d, got)


def test_json_numbers_and_maps(spark):
    df = spark.createDataFrame([({"a": 4.0, "b": 0.1234567, "c": 1e15, "d": None, "e": float("nan"), "f": 1e-9},),
                                ({},), (None,)], "m map<string,double>")
    got = [r["j"] for r in df.select(json_map(F.col("m")).alias("j")).collect()]
    assert got[0] == '{"a":4.0,"b":0.123457,"c":1000000000000000.0,"d":null,"e":null,"f":0.0}'
    assert json.loads(got[0])["b"] == 0.123457 and got[1:] == ["{}", None]
    assert spark.range(1).select(json_number(F.lit(float("inf"))).alias("t")).first()["t"] == "null"

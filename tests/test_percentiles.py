"""Exact percentiles by selection, and stage records grouped by content."""

import random

import numpy as np
from pyspark.sql import functions as F

from perfkit.operators import stage_metrics as sm
from perfkit.sources import eventlog as ev


def test_percentiles_of_hot_and_small_stages(spark):
    rng = random.Random(4)
    stages = {("a", 1): [int(rng.paretovariate(0.7) * 50) for _ in range(20_000)], ("a", 2): [7], ("b", 1): [0, 0, 3],
              ("b", 2): [10 ** 17, 5, 10 ** 9, 99, 100], ("b", 3): [42] * 1000, ("b", -1): [1, 2]}
    rows = [(a, s, 0, d) for (a, s), ds in stages.items() for d in ds]
    counted = (spark.createDataFrame(rows, "log_id string, stage_id bigint, attempt bigint, duration_ms bigint")
               .groupBy("log_id", "stage_id", "attempt", "duration_ms").agg(F.count("*").alias("n")))
    got = {(r["log_id"], r["stage_id"]): (r["p50"], r["p95"]) for r in sm.percentiles(counted).collect()}
    assert got.keys() == stages.keys()
    for key, ds in stages.items():
        assert np.allclose(got[key], np.quantile(ds, [0.5, 0.95]), rtol=1e-12), key


def test_buckets_ascend_with_the_duration(spark):
    values = sorted({d for k in range(18) for d in (10 ** k - 1, 10 ** k, 10 ** k + 1, 37 * 10 ** k)} | {2 ** 63 - 1})
    rows = spark.createDataFrame([(v,) for v in values], "d bigint").select("d", sm._bucket(F.col("d")).alias("b"))
    buckets = [r["b"] for r in rows.orderBy("d").collect()]
    assert buckets == sorted(buckets) and buckets[:3] == [0, 1, 2]


def test_repeated_records_without_ids_stay_apart(spark):
    same = '{"Event":"SparkListenerStageCompleted","Stage Info":{"Stage Name":"s","Number of Tasks":%d}}'
    lines = [("L", same % 1)] * 2500 + [("L", same % n) for n in range(2, 12)]
    lines += [("L", '{"Event":"SparkListenerTaskEnd","Task Metrics":{"Executor Run Time":%d}}' % i) for i in range(1, 4)]
    rows = ev.stage_rows(ev.parse_events(spark.createDataFrame(lines, "log_id string, value string")))
    content = sm.row_content(rows)
    assert content.where("stage_rec is not null").count() == 11
    metrics, _ = sm.profile_from_rows(rows)
    out = metrics.groupBy("num_tasks").count().collect()
    assert {r["num_tasks"]: r["count"] for r in out} == {1: 2500, **{n: 1 for n in range(2, 12)}}
    assert {r["task_p50_ms"] for r in metrics.collect()} == {2.0}
    plan = metrics._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "percentile" not in plan

import json

from perfkit.operators import advice as adv
from perfkit.operators import findings as fd
from perfkit.operators import report as rp

MCOLS = ("app_id string, stage_id bigint, attempt bigint, name string, num_tasks bigint, "
         "stage_duration_ms bigint, task_p50_ms double, task_p95_ms double, task_max_ms bigint, "
         "skew_ratio_p95_p50 double, skew_ratio_max_p50 double, gc_pct double, shuffle_read_mb double, "
         "shuffle_write_mb double, spill_mb double")


def test_report_and_json_exact(spark):
    apps = spark.createDataFrame([("log-7", "app7", "nightly"), ("log-8", "app8", None)],
                                 "log_id string, app_id string, app_name string")
    m = spark.createDataFrame([("app7", 12, 0, "s", 64, 91000, 250.0, 1000.0, 9000, 4.0, 36.0, 0.02, 3.0, 1.0, 0.0)],
                              MCOLS)
    f = fd.findings_all(m)
    recs = adv.recommend(f)
    rule = adv.RULES[0]
    rows = rp.report_lines(apps, m, f, recs).orderBy("app_id", "section", "item", "line_no").collect()
    evidence = '{"p95_p50":4.0,"max_p50":36.0,"p50_ms":250.0,"p95_ms":1000.0,"max_ms":9000.0}'
    assert [r["line"] for r in rows if r["app_id"] == "app7"] == [
        "Profile of nightly (app7)", "from log-7",
        "stage 12 ran 91000 ms: 64 tasks, typical 250 ms, p95 1000 ms, slowest 9000 ms; shuffled 4 MB, "
        "spilled 0 MB, collector 2.0%",
        "ERROR SKEW_DETECTED, stage 12: stage 12: slow tail, 95th percentile at 4.00 and slowest task at "
        "36.00 times the median",
        f"{rule[1]} (ERROR, stage 12)", f"   {rule[2]}",
        *[f"   step {i} {a}" for i, a in enumerate(rule[3], 1)], f"   measured {evidence}"]
    assert [r["line"] for r in rows if r["app_id"] == "app8"] == [
        "Profile of unnamed (app8)", "from log-8", "the log has no completed stage", "nothing stands out",
        "nothing to change"]
    js = [json.loads(r["json"]) for r in adv.recommendations_json(recs).collect()]
    assert js == [{"severity": "ERROR", "title": rule[1], "stage_id": 12, "rationale": rule[2],
                   "actions": rule[3], "evidence": json.loads(evidence)}]

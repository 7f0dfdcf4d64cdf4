import json

from perfkit.operators import advice as adv
from perfkit.operators import findings as fd
from perfkit.operators import report as rp
from perfkit.sources import conf as cf

FCOLS = ("app_id string, detector_seq int, code_seq int, code string, severity string, stage_id bigint, "
         "attempt bigint, message string, evidence map<string,double>")


def findings(spark, rows):
    return spark.createDataFrame(rows, FCOLS)


def test_rules_cover_codes_and_counts(spark):
    counts = {r[0]: len(r[3]) for r in adv.RULES}
    assert counts == {"SKEW_DETECTED": 4, "SHUFFLE_HEAVY": 4, "SPILL_DETECTED": 3, "GC_PRESSURE": 3,
                      "OVER_PARTITIONED": 3, "UNDER_PARTITIONED": 2, "LOW_DEFAULT_PARALLELISM": 2}


def test_order_flags_and_unknown_codes(spark):
    f = findings(spark, [
        ("a", 4, 3, "LOW_DEFAULT_PARALLELISM", "INFO", None, None, "m", {"x": 1.0}),
        ("a", 2, 1, "SHUFFLE_HEAVY", "WARN", 3, 0, "m", {"x": 1.0}),
        ("a", 1, 1, "SKEW_DETECTED", "WARN", 7, 0, "m", {"x": 1.0}),
        ("a", 3, 1, "SPILL_DETECTED", "ERROR", 9, 0, "m", {"x": 1.0}),
        ("a", 4, 1, "OVER_PARTITIONED", "WARN", None, None, "m", {"x": 1.0}),
        ("a", 9, 1, "MADE_UP", "ERROR", 1, 0, "m", {}),
    ])
    confs = cf.parse_confs(spark.createDataFrame(
        [("a", json.dumps({"spark.sql.adaptive.enabled": "true"}))], "app_id string, json string"))
    recs = sorted(adv.recommend(f, confs).collect(), key=lambda r: r["rec_seq"])
    assert [r["code"] for r in recs] == ["SPILL_DETECTED", "SHUFFLE_HEAVY", "SKEW_DETECTED",
                                        "OVER_PARTITIONED", "LOW_DEFAULT_PARALLELISM"]
    skew = recs[2]
    assert skew["n_adjusted"] == 1 and skew["actions"][1] == adv.RULES[0][5]
    assert skew["actions"][2] == adv.RULES[0][3][2]
    js = {r["rec_seq"]: json.loads(r["json"]) for r in adv.recommendations_json(adv.recommend(f, confs)).collect()}
    assert js[5]["stage_id"] is None and len(js[1]["actions"]) == 3


def test_report_lines_sections(spark):
    apps = spark.createDataFrame([("log-a", "a", "job"), ("log-b", "b", None)],
                                 "log_id string, app_id string, app_name string")
    mcols = ("app_id string, stage_id bigint, attempt bigint, name string, num_tasks bigint, "
             "stage_duration_ms bigint, task_p50_ms double, task_p95_ms double, task_max_ms bigint, "
             "skew_ratio_p95_p50 double, skew_ratio_max_p50 double, gc_pct double, shuffle_read_mb double, "
             "shuffle_write_mb double, spill_mb double")
    m = spark.createDataFrame([("a", 1, 0, "s", 200, 1000, 100.0, 500.0, 2000, 5.0, 20.0, 0.01, 0.0, 0.0, 0.0)],
                              mcols)
    f = fd.findings_all(m)
    recs = adv.recommend(f)
    lines = rp.report_lines(apps, m, f, recs).orderBy("app_id", "section", "item", "line_no").collect()
    a = [r["line"] for r in lines if r["app_id"] == "a"]
    b = [r["line"] for r in lines if r["app_id"] == "b"]
    assert any("SKEW_DETECTED" in x for x in a) and any(x.startswith("stage 1 ran 1000 ms: 200 tasks") for x in a)
    assert "nothing stands out" in b and "nothing to change" in b
    assert "the log has no completed stage" in b

import json

from perfkit.operators import cost as co
from perfkit.operators import findings as fd
from perfkit.operators.stage_metrics import profile_stages
from perfkit.sources import conf as cf
from perfkit.sources import eventlog as ev
from tests.test_eventlog import stage, task


def test_conf_long_form(spark):
    raw = spark.createDataFrame([("a", json.dumps({"x": "1", "y": "2"})), ("b", None)],
                                "app_id string, json string")
    rows = sorted((r["app_id"], r["key"], r["value"]) for r in cf.conf_long(cf.parse_confs(raw)).collect())
    assert rows == [("a", "x", "1"), ("a", "y", "2")]


def test_app_runtime_and_approx_percentiles(spark):
    lines = spark.createDataFrame(
        [("L", stage(1, sub=1000, comp=61000)), ("L", stage(2, sub=5000, comp=91000))]
        + [("L", task(stage=1, tid=i, launch=0, finish=i)) for i in range(1, 101)],
        "log_id string, value string")
    events = ev.parse_events(lines)
    rt = co.app_runtime(ev.parse_stages(events)).first()
    assert rt["runtime_seconds"] == 90
    metrics, _ = profile_stages(events, materialize=False)
    e = {r["stage_id"]: r for r in metrics.collect()}
    assert e[1]["task_p50_ms"] == 50.5
    flat = fd.flat_findings(fd.findings_all(metrics)).collect()
    assert all(r["key"] and r["value"] is not None for r in flat)

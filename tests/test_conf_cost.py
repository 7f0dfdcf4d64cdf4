import json

import pytest

from perfkit.operators import cost as co
from perfkit.sources import conf as cf


def typed(spark, conf: dict):
    raw = spark.createDataFrame([("a", json.dumps(conf))], "app_id string, json string")
    return cf.conf_typed(cf.parse_confs(raw)).first()


@pytest.mark.parametrize("val,expect", [(" TRUE ", True), ("yes", True), ("Y", True), ("1", True),
                                        ("false", False), ("n", False), ("0", False), ("maybe", False)])
def test_conf_bool(spark, val, expect):
    assert typed(spark, {"spark.sql.adaptive.enabled": val})["aqe_enabled"] is expect


@pytest.mark.parametrize("val,expect", [("2000", 2000), (" 8 ", 8), ("abc", 200), (None, 200),
                                        (300.0, 300), (300, 300), ("1e999", 200)])
def test_conf_int(spark, val, expect):
    conf = {} if val is None else {"spark.sql.shuffle.partitions": val}
    assert typed(spark, conf)["shuffle_partitions"] == expect


def test_malformed_confs_are_kept_aside(spark):
    raw = spark.createDataFrame([("a", '{"x": "1"'), ("b", "[1]"), ("c", ""), ("d", None), ("e", " \n"), ("f", "{}"),
                                 ("g", "text"), ("h", '{"x": 1}')], "app_id string, json string")
    assert sorted(r["app_id"] for r in cf.rejected_confs(raw).collect()) == ["a", "b", "g"]
    kept = {r["app_id"]: r["conf"] for r in cf.parse_confs(raw).collect()}
    assert kept == {"c": {}, "d": {}, "e": {}, "f": {}, "h": {"x": "1"}}


def test_read_confs_file_names(spark, tmp_path):
    (tmp_path / "app-7.json").write_text(json.dumps({"spark.default.parallelism": "4"}))
    r = cf.conf_typed(cf.read_confs(spark, str(tmp_path))).first()
    assert (r["app_id"], r["default_parallelism"], r["shuffle_partitions"]) == ("app-7", 4, 200)


def test_cluster_validation_and_settings(spark):
    cl = spark.createDataFrame(
        [("a", 10, 4, 16.0, 0.45, 0.0, 0.0), ("b", 0, 4, 16.0, 0.0, 0.0, 0.0), ("c", 2, 4, 0.0, 0.0, 0.0, 0.0)],
        "app_id string, nodes int, cores_per_node int, memory_gb_per_node double, rate_per_node_hour double, "
        "rate_per_dbu_hour double, dbus_per_node double")
    rej = {r["app_id"]: r["reason"] for r in cf.rejected_clusters(cl).collect()}
    assert set(rej) == {"b", "c"} and "nodes" in rej["b"]
    confs = cf.parse_confs(spark.createDataFrame([("a", "{}")], "app_id string, json string"))
    s = cf.app_settings(confs, cl).collect()
    assert len(s) == 1 and s[0]["cores_total"] == 40 and s[0]["shuffle_partitions"] == 200


INP = ("app_id string, scenario string, runtime_seconds bigint, nodes bigint, rate_per_node_hour double, "
       "dbus_per_node double, rate_per_dbu_hour double")


def test_cost_worked_example_and_dbu(spark):
    rows = [("a", "current", 1800, 10, 0.45, 0.0, 0.0), ("a", "optimized", 900, 10, 0.45, 0.0, 0.0),
            ("b", "current", -5, 0, 0.45, 2.0, 0.15)]
    c = {(r["app_id"], r["scenario"]): r for r in co.estimate_cost(spark.createDataFrame(rows, INP)).collect()}
    a = c[("a", "current")]
    assert a["node_hours"] == 5.0 and abs(a["estimated_cost"] - 2.25) < 1e-12
    assert a["dbus"] is None and a["rate_per_dbu_hour"] is None and a["estimated_cost_dbu"] is None
    b = c[("b", "current")]
    assert b["runtime_seconds"] == 0 and b["nodes"] == 1 and b["dbus"] == 0.0 and b["rate_per_dbu_hour"] == 0.15
    cmp = co.compare_cost(co.estimate_cost(spark.createDataFrame(rows, INP))).collect()
    assert len(cmp) == 1 and abs(cmp[0]["savings"] - 1.125) < 1e-12 and cmp[0]["node_hours_saved"] == 2.5

"""Plans and SQL metrics from event logs, and the detectors on them."""

import json

import pytest

from perfkit.functions.conf_values import conf_bytes
from perfkit.operators import advice
from perfkit.operators import plan_findings as pf
from perfkit.sources import eventlog as ev
from perfkit.sources import sqlplans as sq

GB = 1 << 30


def node(name, *children, text=None, **metrics):
    return {"nodeName": name, "simpleString": text or name, "children": list(children), "metadata": {},
            "metrics": [{"name": k.replace("_", " "), "accumulatorId": v, "metricType": "sum"} for k, v in metrics.items()]}


def side(at):
    scan = node("Scan parquet db.t", number_of_files_read=at, size_of_files_read=at + 1, number_of_output_rows=at + 2)
    return node("Sort", node("AQEShuffleRead", node("Exchange", scan, data_size=at + 3)))


def join(name="SortMergeJoin", kind="Inner", at=0, left=None, right=None):
    return node(name, left or side(at + 10), right or side(at + 20), text=f"{name} [k#1], [k#2], {kind}",
                number_of_output_rows=at + 1)


def start(plan, execution=1, kind=sq.QUERY_START):
    return json.dumps({"Event": kind, "executionId": execution, "sparkPlanInfo": plan, "time": 1})


def stage(number, values, tasks=4, attempt=0, spelling="ID"):
    return json.dumps({"Event": "SparkListenerStageCompleted", "Stage Info": {
        f"Stage {spelling}": number, f"Stage Attempt {spelling}": attempt, "Number of Tasks": tasks, "Accumulables": [
            {"ID": k, "Name": "x", "Value": v} for k, v in values.items()]}})


def driver(values, execution=1):
    return json.dumps({"Event": sq.DRIVER_UPDATE, "executionId": execution, "accumUpdates": [list(x) for x in values.items()]})


def findings(spark, lines, limits=None):
    df = spark.createDataFrame([("L", x) for x in lines], "log_id string, value string")
    apps = ev.parse_apps(ev.parse_events(df))
    return pf.plan_findings(sq.node_facts(df), apps, limits=limits)


def codes(df):
    return sorted((r["code"], r["severity"], r["stage_id"]) for r in df.collect())


def test_flatten_keeps_the_tree_of_any_depth():
    deep = node("Leaf")
    for _ in range(3000):
        deep = node("Project", deep)
    rows = list(sq.flatten(deep))
    assert len(rows) == 3001 and rows[-1][:3] == (3000, 2999, "Leaf")
    rows = list(sq.flatten(join(left=node("A", node("B")), right=side(20))))
    assert [(r[0], r[1], r[2]) for r in rows[:4]] == [(0, None, "SortMergeJoin"), (1, 0, "A"), (2, 1, "B"), (3, 0, "Sort")]
    assert dict(rows[0][4]) == {"number of output rows": 1, sq.RIGHT_SIZE: 23}  # no shuffle below the left side


def test_latest_plan_wins(spark):
    early, late = join(at=0), join("BroadcastHashJoin", at=100)
    final = node("AdaptiveSparkPlan", join("CartesianProduct", at=50), text="AdaptiveSparkPlan isFinalPlan=true")
    lines = [start(late, 1, sq.REPLAN), start(early, 1), start(early, 2), start(late, 3, sq.REPLAN),
             start(final, 3, sq.REPLAN), '{"Event":"' + sq.QUERY_START + '","executionId":4,"sparkPlanInfo":"no plan"}',
             '{"Event":"' + sq.QUERY_START + '","executionId":5,"spark', start({"nodeName": "Leaf"}, 6)]
    df = spark.createDataFrame([("L", x) for x in lines], "log_id string, value string")
    got = {(r["execution_id"], r["name"]) for r in sq.plan_nodes(df).where("node_id <= 1").collect()}
    assert {(1, "BroadcastHashJoin"), (2, "SortMergeJoin"), (3, "CartesianProduct"), (6, "Leaf")} <= got
    assert not any(e in (4, 5) for e, _ in got)


def test_missed_broadcast_respects_join_type_and_limit(spark):
    sizes = [stage(3, {"13": 0, 13: 5 * GB, 23: 1000, 1: 10}, spelling="Id")]
    assert codes(findings(spark, [start(join()), *sizes])) == [("MISSED_BROADCAST", "ERROR", 3)]
    for kind, found in (("LeftOuter", 1), ("RightOuter", 0), ("FullOuter", 0), ("LeftSemi", 1)):
        assert findings(spark, [start(join(kind=kind)), *sizes]).count() == found, kind
    limits = spark.createDataFrame([("L", 999)], "app_id string, broadcast_bytes bigint")
    assert findings(spark, [start(join()), *sizes], limits).count() == 0
    off = spark.createDataFrame([("L", -1)], "app_id string, broadcast_bytes bigint")
    assert findings(spark, [start(join()), *sizes], off).count() == 1
    assert findings(spark, [start(join()), stage(3, {13: 5 * GB})]).count() == 0  # the right side's size is not known


def test_totals_of_several_stages_do_not_add_up(spark):
    lines = [start(join("ShuffledHashJoin")), stage(1, {13: 8 << 20, 23: GB}), stage(2, {13: 11 << 20, 1: 3}, attempt=1)]
    assert codes(findings(spark, lines)) == []
    assert codes(findings(spark, lines[:2])) == [("MISSED_BROADCAST", "ERROR", None)]


def test_nested_loops(spark):
    lines = [start(join("CartesianProduct"), 1), start(join("BroadcastNestedLoopJoin", at=100), 2),
             stage(9, {1: "700", 101: 5}), stage(9, {1: "n/a"})]
    out = findings(spark, lines)
    assert codes(out) == [("NESTED_LOOP_JOIN", "ERROR", 9), ("NESTED_LOOP_JOIN", "WARN", 9)]
    assert {r["evidence"]["output_rows"] for r in out.collect()} == {700.0, 5.0}


def test_file_layout(spark):
    scan = side(10)
    for files, size, tasks, want in ((100, 100 << 20, 50, [("SMALL_FILES", "WARN", 1)]), (99, 99 << 20, 50, []),
                                     (1000, 1000 << 20, 50, [("SMALL_FILES", "ERROR", 1)]), (100, 3200 << 20, 500, []),
                                     (3, 3 * GB, 3, [("UNSPLITTABLE_FILES", "WARN", 1)]), (3, 3 * GB, 24, []), (0, 0, 4, [])):
        lines = [start(scan), driver({10: files, 11: size}), stage(1, {12: 5}, tasks=tasks)]
        assert codes(findings(spark, lines)) == want, files
    assert findings(spark, [stage(1, {12: 5})]).count() == 0


def test_every_plan_finding_has_a_rule():
    assert {pf.MISSED_BROADCAST, pf.NESTED_LOOP, pf.SMALL_FILES, pf.UNSPLITTABLE} <= {r[0] for r in advice.PLAN_RULES}


@pytest.mark.parametrize("text, want", [("10m", 10 << 20), (" 2GB ", 2 << 30), ("-1", -1), ("5 kb", 5120), ("77", 77),
                                        ("10x", 3), ("", 3), (None, 3), ("99999999999t", 3)])
def test_conf_bytes(spark, text, want):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([({"k": text},)], "conf map<string,string>")
    assert df.select(conf_bytes(F.col("conf"), "k", 3).alias("b")).first()["b"] == want

import json

from perfkit.operators.stage_metrics import profile_stages, stage_metrics
from perfkit.sources import eventlog as ev


def _lines(spark, rows):
    return spark.createDataFrame(rows, "log_id string, value string")


def task(stage=1, attempt=0, tid=1, launch=100, finish=200, run=50, spelling="ID", **metrics):
    ti = {f"Task {spelling}": tid}
    if launch is not None:
        ti["Launch Time"] = launch
    if finish is not None:
        ti["Finish Time"] = finish
    tm = {"Executor Run Time": run, "JVM GC Time": metrics.get("gc", 0),
          "Memory Bytes Spilled": metrics.get("mem", 0), "Disk Bytes Spilled": metrics.get("disk", 0),
          "Shuffle Read Metrics": {"Remote Bytes Read": metrics.get("remote", 0),
                                   "Local Bytes Read": metrics.get("local", 0)},
          "Shuffle Write Metrics": {"Shuffle Bytes Written": metrics.get("write", 0)}}
    return json.dumps({"Event": "SparkListenerTaskEnd", f"Stage {spelling}": stage,
                       f"Stage Attempt {spelling}": attempt, "Task Info": ti, "Task Metrics": tm})


def stage(stage=1, attempt=0, n=3, sub=0, comp=1000, spelling="ID"):
    info = {f"Stage {spelling}": stage, f"Stage Attempt {spelling}": attempt, "Stage Name": f"s{stage}",
            "Number of Tasks": n}
    if sub is not None:
        info["Submission Time"] = sub
    if comp is not None:
        info["Completion Time"] = comp
    return json.dumps({"Event": "SparkListenerStageCompleted", "Stage Info": info})


def start(app_id, name, ts, spelling="ID"):
    return json.dumps({"Event": "SparkListenerApplicationStart", "App Name": name,
                       f"App {spelling}": app_id, "Timestamp": ts})


def test_parse_tasks_spellings_defaults_and_duration(spark):
    rows = [("L", task(tid=1)), ("L", task(tid=2, spelling="Id", stage=2, attempt=1)),
            ("L", task(tid=3, finish=None, run=77)),          # no finish -> run time
            ("L", task(tid=4, launch=500, finish=100)),       # negative -> 0
            ("L", json.dumps({"Event": "SparkListenerTaskEnd"})),  # everything missing
            ("L", "   "), ("L", ""),                           # blank lines
            ("L", '{"Event":"SparkListenerTaskEnd",'),         # malformed
            ("L", json.dumps({"Event": "SparkListenerJobStart", "Job ID": 1}))]
    lines = _lines(spark, rows)
    t = {r["task_id"]: r for r in ev.parse_tasks(ev.parse_events(lines)).collect()}
    assert set(t) == {1, 2, 3, 4, 0}
    assert (t[2]["stage_id"], t[2]["attempt"]) == (2, 1)
    assert t[1]["duration_ms"] == 100 and t[3]["duration_ms"] == 77 and t[4]["duration_ms"] == 0
    assert (t[0]["stage_id"], t[0]["attempt"], t[0]["duration_ms"], t[0]["gc_time_ms"]) == (-1, 0, 0, 0)
    assert ev.rejected_lines(lines).count() == 1


def test_quoted_and_fractional_numbers_are_read(spark):
    line = json.loads(task(tid=5, launch=10, finish=40))
    line["Stage ID"] = "7"
    line["Task Info"]["Launch Time"] = 10.0
    line["Task Metrics"]["JVM GC Time"] = "55"
    line["Task Metrics"]["Memory Bytes Spilled"] = " 12.9 "
    line["Task Metrics"]["Disk Bytes Spilled"] = None
    lines = _lines(spark, [("L", json.dumps(line))])
    r = ev.parse_tasks(ev.parse_events(lines)).first()
    assert (r["stage_id"], r["duration_ms"], r["gc_time_ms"], r["spill_mem_bytes"], r["spill_disk_bytes"]) == (
        7, 30, 55, 12, 0)
    assert ev.rejected_lines(lines).isEmpty()


def test_every_unreadable_line_is_kept_aside(spark):
    bad = [json.dumps({"Event": "SparkListenerTaskEnd", "Stage ID": "seven"}),
           json.dumps({"Event": "SparkListenerTaskEnd", "Stage ID": 10 ** 30}),
           json.dumps({"Event": "SparkListenerStageCompleted", "Stage Info": {"Number of Tasks": ""}}),
           '{"Event":"SparkListenerTa', '{"Event":"SparkListenerTaskEnd","Stage ID":', "no json"]
    good = [task(), stage(), start("a", "n", 1), "", "  ", "\t",
            json.dumps({"Event": "SparkListenerJobStart", "Stage ID": "x"}), json.dumps({"Other": 1})]
    lines = _lines(spark, [("L", v) for v in bad + good])
    assert sorted(r["value"] for r in ev.rejected_lines(lines).collect()) == sorted(bad)
    assert ev.parse_events(lines).count() == 3


def test_shuffle_read_is_remote_plus_local(spark):
    lines = _lines(spark, [("L", task(remote=10, local=5, write=7, mem=3, disk=2, gc=9))])
    r = ev.parse_tasks(ev.parse_events(lines)).first()
    assert (r["shuffle_read_bytes"], r["shuffle_write_bytes"], r["spill_mem_bytes"],
            r["spill_disk_bytes"], r["gc_time_ms"]) == (15, 7, 3, 2, 9)


def test_apps_last_record_wins_and_missing_start(spark):
    lines = _lines(spark, [("A", start("app-1", "old", 1)), ("A", start("app-1b", "new", 2, "Id")),
                           ("B", task()), ("B", stage())])
    apps = {r["log_id"]: r for r in ev.parse_apps(ev.parse_events(lines)).collect()}
    assert apps["A"]["app_id"] == "app-1b" and apps["A"]["app_name"] == "new"
    m, a = profile_stages(ev.parse_events(lines), materialize=False)
    assert m.first()["app_id"] == "B"  # no start record: keyed by the log (N13)


def test_read_eventlog_files_and_rolled(spark, tmp_path):
    d = tmp_path / "logs" / "app-9"
    d.mkdir(parents=True)
    (d / "events_1").write_text(start("app-9", "n", 1) + "\n" + stage() + "\n")
    (d / "events_2").write_text(task() + "\n\n" + task(tid=2) + "\n")
    lines = ev.read_eventlog(spark, str(tmp_path / "logs"), rolled=True)
    assert lines.select("log_id").distinct().count() == 1
    m, _ = profile_stages(ev.parse_events(lines), materialize=False)
    r = m.first()
    assert r["app_id"] == "app-9" and r["num_tasks"] == 3
    per_file = ev.read_eventlog(spark, str(tmp_path / "logs"))
    assert per_file.select("log_id").distinct().count() == 2


def test_stage_metrics_semantics(spark):
    rows = [("L", start("app", "n", 1)),
            ("L", stage(1, n=12, sub=0, comp=5000)),
            ("L", stage(1, n=12, sub=0, comp=5000)),          # repeated record -> repeated row
            ("L", stage(2, n=20, sub=None, comp=None)),       # no tasks, no times
            ("L", stage(3, n=4, sub=900, comp=100)),          # negative -> 0
            ("L", task(stage=9))]                             # task without stage: dropped
    durations = [100, 200, 300, 1000]
    for i, d in enumerate(durations):
        rows.append(("L", task(stage=1, tid=i, launch=0, finish=d, gc=d // 10, mem=1 << 20)))
    lines = _lines(spark, rows)
    events = ev.parse_events(lines)
    m, _ = profile_stages(events, materialize=False)
    got = sorted((r.asDict() for r in m.collect()), key=lambda r: r["stage_id"])
    assert [r["stage_id"] for r in got] == [1, 1, 2, 3]
    s1 = got[0]
    import numpy as np
    assert s1["task_p50_ms"] == float(np.percentile(durations, 50))
    assert s1["task_p95_ms"] == float(np.percentile(durations, 95))
    assert s1["task_max_ms"] == 1000 and s1["stage_duration_ms"] == 5000
    assert abs(s1["gc_pct"] - 160 / 1600) < 1e-12 and s1["spill_mb"] == 4.0
    assert s1["skew_ratio_max_p50"] == 1000 / 250
    s2 = got[2]
    assert (s2["task_p50_ms"], s2["task_max_ms"], s2["gc_pct"], s2["stage_duration_ms"]) == (0.0, 0, 0.0, 0)
    assert got[3]["stage_duration_ms"] == 0
    # the two-frame operator agrees with the single-scan one
    apps = ev.parse_apps(events)
    m2 = stage_metrics(ev.parse_stages(events), ev.parse_tasks(events), apps)
    cols = [c for c in m.columns if c != "log_id"]
    assert m.select(cols).exceptAll(m2.select(cols)).count() == 0
    assert m2.count() == 4
    # stage duration falls back to the longest task when a time is missing
    lines2 = _lines(spark, [("L", stage(5, sub=None)), ("L", task(stage=5, launch=0, finish=70))])
    r = profile_stages(ev.parse_events(lines2), materialize=False)[0].first()
    assert r["stage_duration_ms"] == 70

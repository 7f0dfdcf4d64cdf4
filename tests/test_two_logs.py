"""Two logs of one application: each is reported for itself."""

import os

from perfkit.operators import advice as adv
from perfkit.operators import findings as fd
from perfkit.operators import report as rp
from perfkit.operators.stage_metrics import profile_stages, top_stages
from perfkit.plans import profile as pf
from perfkit.sources import eventlog as ev
from tests.test_eventlog import stage, start, task

CLUSTERS = ("app_id string, nodes int, cores_per_node int, memory_gb_per_node double, rate_per_node_hour double, "
            "rate_per_dbu_hour double, dbus_per_node double")


def lines(slow):
    """One stage of 20 tasks; with ``slow`` one of them takes 20 times the others'."""
    return [start("app-1", "job", 1), stage(1, n=20)] + [
        task(tid=i, launch=0, finish=2000 if slow and i == 0 else 100) for i in range(20)]


def parsed(spark):
    rows = [("run-a", x) for x in lines(True)] + [("run-b", x) for x in lines(False)]
    return profile_stages(ev.parse_events(spark.createDataFrame(rows, "log_id string, value string")))


def settings(spark):
    return spark.createDataFrame([("app-1", 40, 8, 0), ("no-log", 40, 8, 0)],
                                 "app_id string, cores_total bigint, shuffle_partitions bigint, default_parallelism bigint")


def test_stages_findings_and_ranks_are_per_log(spark):
    m, apps = parsed(spark)
    assert sorted((r["log_id"], r["stage_rank"]) for r in top_stages(m, 10).collect()) == [("run-a", 1), ("run-b", 1)]
    f = fd.findings_all(m, settings(spark), apps)
    recs = adv.recommend(f).collect()
    got = sorted((r["log_id"] or "", r["app_id"], r["rec_seq"], r["code"]) for r in recs)
    assert got == [("", "no-log", 1, "UNDER_PARTITIONED"), ("run-a", "app-1", 1, "SKEW_DETECTED"),
                   ("run-a", "app-1", 2, "UNDER_PARTITIONED"), ("run-b", "app-1", 1, "UNDER_PARTITIONED")]


def test_report_has_one_text_per_log(spark):
    m, apps = parsed(spark)
    f = fd.findings_all(m)
    out = rp.report_lines(apps, m, f, adv.recommend(f)).orderBy("log_id", "section", "item", "line_no").collect()
    a = [r["line"] for r in out if r["log_id"] == "run-a"]
    b = [r["line"] for r in out if r["log_id"] == "run-b"]
    assert a[:2] == ["Profile of job (app-1)", "from run-a"] and b[:2] == ["Profile of job (app-1)", "from run-b"]
    assert sum(x.startswith("stage 1 ran") for x in a) == sum(x.startswith("stage 1 ran") for x in b) == 1
    assert any("SKEW_DETECTED" in x for x in a) and b[3:] == ["nothing stands out", "nothing to change"]


def test_rows_without_a_log_count_for_each_log(spark):
    m, apps = parsed(spark)
    f = fd.findings_all(m.where("log_id = 'run-a'").drop("log_id"))
    out = rp.report_lines(apps, m, f, adv.recommend(f)).collect()
    assert sorted(r["log_id"] for r in out if "SKEW_DETECTED" in r["line"]) == ["run-a", "run-b"]


def test_sinks_write_one_folder_per_log(spark, tmp_path):
    logs = tmp_path / "logs"
    long = "x" * 200  # a name that leaves no room for an escaped path
    for name, slow in (("one", True), (long, False)):
        (logs / name).mkdir(parents=True)
        (logs / name / "events").write_text("\n".join(lines(slow)))
    clusters = spark.createDataFrame([("app-1", 10, 4, 16.0, 0.45, 0.0, 0.0)], CLUSTERS)
    out = pf.profile(spark, str(logs), clusters=clusters, rolled=True)
    pf.write_outputs(out, str(tmp_path / "out"))
    folders = [d for d in os.listdir(tmp_path / "out/report/app_id=app-1") if d.startswith("log=")]
    assert len(folders) == 2
    for d in folders:
        parts = [f for f in os.listdir(tmp_path / f"out/report/app_id=app-1/{d}") if f.startswith("part-")]
        text = "".join(open(tmp_path / f"out/report/app_id=app-1/{d}/{p}").read() for p in sorted(parts))
        assert text.startswith("Profile of job (app-1)\nfrom ") and text.count("Profile of") == 1

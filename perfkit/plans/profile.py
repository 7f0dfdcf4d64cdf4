"""Event logs + confs + clusters -> metrics, findings, recommendations, report.

One call profiles every application found under the given paths. Tasks and stages are read in
one scan of the event logs (see ``stage_metrics.profile_stages``), query plans and their
metrics in further ones that parse only those lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from perfkit.operators import advice, cost, findings, plan_findings, report
from perfkit.operators.stage_metrics import profile_stages
from perfkit.sources import conf, eventlog, sqlplans


def profile(spark: SparkSession, eventlog_paths, conf_paths=None, clusters: DataFrame | None = None,
            rolled: bool = False, conf_by: str = "file") -> dict[str, DataFrame]:
    lines = eventlog.read_eventlog(spark, eventlog_paths, rolled=rolled)
    events = eventlog.parse_events(lines)
    metrics, apps = profile_stages(events)
    confs = conf.read_confs(spark, conf_paths, by=conf_by) if conf_paths else None
    settings = conf.app_settings(confs, clusters) if (confs is not None and clusters is not None) else None
    plans = plan_findings.plan_findings(sqlplans.node_facts(lines), apps,
                                        limits=conf.broadcast_limits(confs) if confs is not None else None)
    f = findings.findings_all(metrics, settings, apps).unionByName(plans)
    recs = advice.recommend(f, confs)
    out = {"lines": lines, "apps": apps, "metrics": metrics, "findings": f, "recommendations": recs,
           "report": report.report_lines(apps, metrics, f, recs),
           "rejects": eventlog.rejected_lines(lines)}
    if conf_paths:
        out["conf_rejects"] = conf.rejected_confs(conf.read_conf_texts(spark, conf_paths, by=conf_by))
    if clusters is not None:
        out["cost"] = observed_cost(apps, clusters)
    return out


def observed_cost(apps: DataFrame, clusters: DataFrame) -> DataFrame:
    """C1, C2 with the runtime each application's log implies (scenario ``observed``).

    The reference takes runtime as an argument; deriving it from the logs lets every
    profiled application be priced in the same job.
    """
    inputs = apps.join(clusters, "app_id").select(
        "app_id", F.lit("observed").alias("scenario"), "runtime_seconds",
        F.col("nodes").cast("bigint").alias("nodes"), "rate_per_node_hour", "dbus_per_node",
        "rate_per_dbu_hour")
    return cost.estimate_cost(inputs)


def write_outputs(out: dict[str, DataFrame], path: str) -> None:
    """Report text and recommendation JSON lines, one folder per log."""
    report.write_report(out["report"], f"{path}/report")
    advice.write_recommendations(out["recommendations"], f"{path}/recommendations")

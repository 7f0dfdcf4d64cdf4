"""Cost estimates for many applications at once.

Input rows: ``(app_id, scenario, runtime_seconds, nodes, rate_per_node_hour,
dbus_per_node, rate_per_dbu_hour)``. Every column is a narrow expression; the
comparison is a join of the two scenarios on ``app_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COST_COLUMNS = ["app_id", "scenario", "runtime_seconds", "nodes", "node_hours", "rate_per_node_hour",
                "estimated_cost", "dbus", "rate_per_dbu_hour", "estimated_cost_dbu"]


def estimate_cost(inputs: DataFrame) -> DataFrame:
    """Node-hours and cost; DBU figures only when both DBU inputs are non-zero."""
    secs = F.greatest(F.lit(0).cast("bigint"), F.col("runtime_seconds").cast("bigint"))
    nodes = F.greatest(F.lit(1).cast("bigint"), F.col("nodes").cast("bigint"))
    hours = secs / F.lit(3600.0)
    dpn = F.coalesce(F.col("dbus_per_node").cast("double"), F.lit(0.0))
    rdbu = F.coalesce(F.col("rate_per_dbu_hour").cast("double"), F.lit(0.0))
    rate = F.coalesce(F.col("rate_per_node_hour").cast("double"), F.lit(0.0))
    use_dbu = (dpn != 0) & (rdbu != 0)
    dbus = F.when(use_dbu, hours * nodes * dpn)
    return inputs.select(
        "app_id", "scenario", secs.alias("runtime_seconds"), nodes.alias("nodes"),
        (hours * nodes).alias("node_hours"), rate.alias("rate_per_node_hour"),
        (hours * nodes * rate).alias("estimated_cost"), dbus.alias("dbus"),
        F.when(rdbu != 0, rdbu).alias("rate_per_dbu_hour"),
        F.when(use_dbu, hours * nodes * dpn * rdbu).alias("estimated_cost_dbu"))


def compare_cost(costs: DataFrame, current: str = "current", optimized: str = "optimized") -> DataFrame:
    """Current vs optimized cost and node-hours per application."""
    cur = costs.where(F.col("scenario") == current).select(
        "app_id", F.col("estimated_cost").alias("current_cost"),
        F.col("node_hours").alias("current_node_hours"))
    opt = costs.where(F.col("scenario") == optimized).select(
        "app_id", F.col("estimated_cost").alias("optimized_cost"),
        F.col("node_hours").alias("optimized_node_hours"))
    j = cur.join(opt, "app_id", "inner")
    return j.select(
        "app_id", "current_cost", "optimized_cost",
        (F.col("current_cost") - F.col("optimized_cost")).alias("savings"),
        "current_node_hours", "optimized_node_hours",
        (F.col("current_node_hours") - F.col("optimized_node_hours")).alias("node_hours_saved"))


def app_runtime(stages: DataFrame) -> DataFrame:
    """Per-log runtime in seconds: last stage completion minus first submission.

    Not in the reference (it takes runtime as an argument); lets cost be estimated
    for every profiled application in the same job.
    """
    g = stages.groupBy("log_id").agg(F.min("submission_time_ms").alias("first"),
                                     F.max("completion_time_ms").alias("last"))
    return g.select("log_id", F.coalesce(F.expr("(last - first) div 1000"),
                                         F.lit(0).cast("bigint")).alias("runtime_seconds"))

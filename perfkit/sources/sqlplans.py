"""Physical plans and SQL metrics from event logs.

Query start and adaptive re-plan events carry a recursive plan tree. The latest plan of each query
is flattened into one row per node; a node's metrics name accumulators, whose values come from the
stage-completed records (totals per stage, so no task record is read for them) and from driver updates. A
metric's stage is the stage that reports its accumulator.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfkit.sources.eventlog import CORRUPT, NUMBER, STAGE_COMPLETED

# The event kinds read here, and the nodes and metrics looked at.
_UI = "org.apache.spark.sql.execution.ui."
QUERY_START = _UI + "SparkListenerSQLExecutionStart"
REPLAN = _UI + "SparkListenerSQLAdaptiveExecutionUpdate"
DRIVER_UPDATE = _UI + "SparkListenerDriverAccumUpdates"
FINAL = "isFinalPlan=true"
DATA_SIZE, OUTPUT_ROWS = "data size", "number of output rows"
FILES_READ, FILE_BYTES = "number of files read", "size of files read"
# Names of our own for the data sizes of the shuffles below a join.
LEFT_SIZE, RIGHT_SIZE = "left data size", "right data size"

NODES = ("log_id string, execution_id bigint, node_id int, parent_id int, name string, description string, "
         "metrics array<struct<name: string, accumulator_id: bigint>>")

#: Nodes that a worker holds as Python objects.
HELD_NODES = 4096


def latest_plans(lines: DataFrame) -> DataFrame:
    """``(log_id, execution_id, plan)``: per query the final plan, else the latest one, as JSON text.

    Re-plan events have no time of their own; as accumulators are numbered in the order they are made,
    the plan with the greatest accumulator is the latest. Unreadable lines are skipped.
    """
    wanted = F.col("value").contains(QUERY_START) | F.col("value").contains(REPLAN)
    j = F.from_json("value", f"`Event` string, `executionId` {NUMBER}, `sparkPlanInfo` string, `_bad` string", CORRUPT)
    ev = lines.where(wanted).select("log_id", F.explode(F.array(j)).alias("j")).where(
        F.col("j.Event").isin(QUERY_START, REPLAN) & F.col("j.sparkPlanInfo").isNotNull()
        & F.col("j.executionId").isNotNull() & F.col("j._bad").isNull())
    plan = F.col("j.sparkPlanInfo")
    newest = F.array_max(F.transform(F.regexp_extract_all(plan, F.lit(r'"accumulatorId"\s*:\s*(\d+)'), 1),
                                     lambda x: x.try_cast("bigint")))
    order = F.struct(plan.contains(FINAL), F.col("j.Event") == REPLAN, F.coalesce(newest, F.lit(-1).cast("bigint")), plan)
    return ev.groupBy("log_id", F.col("j.executionId").cast("bigint").alias("execution_id")).agg(
        F.max(order).alias("last")).select("log_id", "execution_id", F.col("last.sparkPlanInfo").alias("plan"))


def flatten(plan: dict) -> Iterator[tuple]:
    """(node_id, parent_id, name, description, metrics) in pre-order; a join also has the data sizes of
    the shuffles that feed its sides."""

    def fed_by(node: dict) -> int | None:
        """The data-size accumulator of the nearest shuffle, on a path of nodes with one input."""
        while node:
            if "Exchange" in (node.get("nodeName") or ""):
                return next((m.get("accumulatorId") for m in node.get("metrics") or () if m.get("name") == DATA_SIZE), None)
            inputs = node.get("children") or []
            node = inputs[0] if len(inputs) == 1 else None
        return None

    todo, made = [(plan, None)], 0
    while todo:
        node, parent = todo.pop()
        name, inputs = node.get("nodeName") or "", node.get("children") or []
        metrics = [(m.get("name"), m.get("accumulatorId")) for m in node.get("metrics") or ()]
        if len(inputs) == 2:
            metrics += [(side, at) for side, child in zip((LEFT_SIZE, RIGHT_SIZE), inputs)
                        if (at := fed_by(child)) is not None]
        yield made, parent, name, node.get("simpleString") or "", metrics
        todo += [(child, made) for child in reversed(inputs)]
        made += 1


def plan_nodes(lines: DataFrame) -> DataFrame:
    """One row per node of every query's latest plan: see NODES. A plan that is no JSON has none."""

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        log, execution, node, parent, name, description, metrics = zip(*rows)
        pair = pa.list_(pa.struct([("name", pa.string()), ("accumulator_id", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [pa.array(log, pa.string()), pa.array(execution, pa.int64()), pa.array(node, pa.int32()),
             pa.array(parent, pa.int32()), pa.array(name, pa.string()), pa.array(description, pa.string()),
             pa.array([[{"name": n, "accumulator_id": a} for n, a in m] for m in metrics], pair)],
            names=["log_id", "execution_id", "node_id", "parent_id", "name", "description", "metrics"])

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for log_id, execution_id, text in zip(*(batch.column(c) for c in range(3))):
                try:
                    plan = json.loads(text.as_py())
                except ValueError:
                    continue
                if isinstance(plan, dict):
                    log, execution = log_id.as_py(), execution_id.as_py()
                    for row in flatten(plan):
                        rows.append((log, execution, *row))
                        if len(rows) == HELD_NODES:
                            yield as_batch(rows)
                            rows = []
            if rows:
                yield as_batch(rows)

    return latest_plans(lines).mapInArrow(nodes, NODES)


def accumulators(lines: DataFrame) -> DataFrame:
    """``(log_id, accumulator_id, value, stage_id, attempt, num_tasks)``: totals that stages report and
    driver updates (without a stage). Values that are no whole numbers are left out."""
    item = f"struct<`ID`: {NUMBER}, `Name`: string, `Value`: string>"
    schema = (f"`Event` string, `executionId` {NUMBER}, `accumUpdates` array<array<{NUMBER}>>, "
              f"`Stage Info` struct<`Stage ID`: {NUMBER}, `Stage Id`: {NUMBER}, `Stage Attempt ID`: {NUMBER}, "
              f"`Stage Attempt Id`: {NUMBER}, `Number of Tasks`: {NUMBER}, `Accumulables`: array<{item}>>")
    shape = ("struct<event: string, execution: bigint, updates: array<array<bigint>>, stage: struct<sid_a: bigint, "
             "sid_b: bigint, att_a: bigint, att_b: bigint, tasks: bigint, "
             "all: array<struct<id: bigint, name: string, value: string>>>>")
    wanted = F.col("value").contains(STAGE_COMPLETED) | F.col("value").contains(DRIVER_UPDATE)
    ev = lines.where(wanted).select("log_id", F.explode(F.array(F.from_json("value", schema).cast(shape))).alias("j"))
    none = F.lit(None).cast("bigint")
    stage = ev.where(F.col("j.event") == STAGE_COMPLETED).select(
        "log_id", F.coalesce("j.stage.sid_a", "j.stage.sid_b", F.lit(-1)).alias("stage_id"),
        F.coalesce("j.stage.att_a", "j.stage.att_b", F.lit(0)).alias("attempt"),
        F.coalesce("j.stage.tasks", F.lit(0)).alias("num_tasks"), F.explode("j.stage.all").alias("a"))
    stage = stage.where(~F.coalesce(F.col("a.name"), F.lit("")).startswith("internal.metrics.")).select(
        "log_id", F.col("a.id").alias("accumulator_id"), F.col("a.value").try_cast("bigint").alias("value"),
        "stage_id", "attempt", "num_tasks")
    driver = ev.where(F.col("j.event") == DRIVER_UPDATE).select("log_id", F.explode("j.updates").alias("u")).select(
        "log_id", F.get("u", F.lit(0)).alias("accumulator_id"), F.get("u", F.lit(1)).alias("value"),
        none.alias("stage_id"), none.alias("attempt"), none.alias("num_tasks"))
    return stage.unionByName(driver).where("accumulator_id is not null and value is not null")


def node_facts(lines: DataFrame) -> DataFrame:
    """Joins and scans with their measured figures: ``(log_id, execution_id, node_id, name, description,
    output_rows, files, file_bytes, left_bytes, right_bytes, stage_id, attempt, num_tasks)``.

    Only the metrics used here are joined to the accumulators. An accumulator reported by several stages
    or attempts holds running totals, so the greatest counts; the node belongs to the last of them.
    """
    names = {OUTPUT_ROWS: "output_rows", FILES_READ: "files", FILE_BYTES: "file_bytes", LEFT_SIZE: "left_bytes",
             RIGHT_SIZE: "right_bytes"}
    key = ["log_id", "execution_id", "node_id"]
    kinds = F.col("name").rlike("Join|CartesianProduct") | F.col("name").rlike("^(Scan |FileScan |BatchScan )")
    nodes = plan_nodes(lines).where(kinds).select(*key, "name", "description", F.explode_outer(F.filter(
        "metrics", lambda m: m["name"].isin(*names))).alias("m"))
    nodes = nodes.select(*key, "name", "description", F.col("m.name").alias("metric"),
                         F.col("m.accumulator_id").alias("accumulator_id"))
    own = F.col("metric") == OUTPUT_ROWS
    measured = nodes.join(accumulators(lines), ["log_id", "accumulator_id"], "left")
    return measured.groupBy(*key, "name", "description").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(c) for m, c in names.items()],
        F.max(F.when(own & F.col("stage_id").isNotNull(), F.struct("stage_id", "attempt", "num_tasks"))).alias("_s"),
    ).select("*", "_s.stage_id", "_s.attempt", "_s.num_tasks").drop("_s")

"""Plain-text report as rows (O1-O4) and its text sink (S3).

Output rows: ``(log_id, app_id, section, item, line_no, line)``; ``item`` is an array of sort keys.
Ordering by those keys gives the report; every log has a report of its own, all in the same job. No log's
lines are gathered into one row: the sink sorts globally (range partitioning
splits large logs) and writes one folder per log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfkit.functions.number_text import fixed, json_map
from perfkit.operators.findings import with_log
from perfkit.operators.stage_metrics import top_stages
from perfkit.session import written
from perfkit.sources.eventlog import log_folder

REPORT_COLUMNS = ["log_id", "app_id", "section", "item", "line_no", "line"]

# Section order.
HEADER, TOP, FINDINGS, RECS = 1, 2, 3, 4


def _lines(df: DataFrame, section: int, item: list, lines: Column) -> DataFrame:
    keys = F.array(*[F.coalesce(k if isinstance(k, Column) else F.lit(k), F.lit(-1)).cast("bigint") for k in item])
    return df.select("log_id", "app_id", F.lit(section).alias("section"), keys.alias("item"),
                     F.posexplode(lines).alias("line_no", "line"))


def _where() -> Column:
    return F.when(F.col("stage_id").isNull(), F.lit("whole application")).otherwise(
        F.format_string("stage %d", "stage_id"))


def _without(apps: DataFrame, rows: DataFrame, section: int, text: str) -> DataFrame:
    """A line for the logs that have no rows."""
    return _lines(apps.join(rows.select("log_id").distinct(), "log_id", "left_anti"), section, [0], F.array(F.lit(text)))


def _by_log(df: DataFrame, apps: DataFrame) -> DataFrame:
    """``df`` with rows of a null log repeated for each log of their application (kept as they are if
    it has none)."""
    def key(log: Column, app: Column) -> Column:
        return F.coalesce(F.concat(F.lit("log:"), log), F.concat(F.lit("app:"), app))

    logs = apps.select(F.col("log_id").alias("_log"), F.explode(F.array(
        key(F.col("log_id"), F.col("app_id")), key(F.lit(None), F.col("app_id")))).alias("_key"))
    rows = with_log(df).withColumn("_key", key(F.col("log_id"), F.col("app_id"))).join(logs, "_key", "left")
    return rows.withColumn("log_id", F.coalesce("log_id", "_log")).drop("_key", "_log")


def report_lines(apps: DataFrame, metrics: DataFrame, findings: DataFrame, recs: DataFrame,
                 top_n: int = 10) -> DataFrame:
    """O1-O4 for every log in ``apps`` (``log_id, app_id, app_name``). Rows of the other frames with a null
    log, or none, count for every log of their application."""
    # Several parts of the report read each frame: it is made once and stored.
    metrics, findings, recs = (written(_by_log(df, apps), f"report-{name}") for name, df in (
        ("stages", metrics), ("findings", findings), ("recommendations", recs)))
    head = _lines(apps, HEADER, [0], F.array(
        F.format_string("Profile of %s (%s)", F.coalesce("app_name", F.lit("unnamed")), F.col("app_id")),
        F.format_string("from %s", F.col("log_id"))))

    top = _lines(top_stages(metrics, top_n), TOP, [F.col("stage_rank")], F.array(F.format_string(
        "stage %d ran %d ms: %d tasks, typical %s ms, p95 %s ms, slowest %d ms; shuffled %s MB, "
        "spilled %s MB, collector %s%%",
        "stage_id", "stage_duration_ms", "num_tasks", fixed(F.col("task_p50_ms"), 0), fixed(F.col("task_p95_ms"), 0),
        "task_max_ms", fixed(F.col("shuffle_read_mb") + F.col("shuffle_write_mb"), 0), fixed(F.col("spill_mb"), 0),
        fixed(F.col("gc_pct") * 100, 1))))

    # Production order: detector, stage, attempt, code.
    found = _lines(findings, FINDINGS, [F.col(c) for c in ("detector_seq", "stage_id", "attempt", "code_seq")],
                   F.array(F.format_string("%s %s, %s: %s", F.col("severity"), F.col("code"), _where(),
                                           F.col("message"))))

    seen = F.when(F.size("evidence") > 0, F.array(F.concat(F.lit("   measured "), json_map(F.col("evidence"))))
                  ).otherwise(F.array().cast("array<string>"))
    steps = F.transform("actions", lambda a, i: F.concat(F.lit("   step "), (i + 1).cast("string"), F.lit(" "), a))
    block = F.concat(F.array(F.format_string("%s (%s, %s)", F.col("title"), F.col("severity"), _where()),
                             F.concat(F.lit("   "), F.col("rationale"))), steps, seen)
    advised = _lines(recs, RECS, [F.col("rec_seq")], block)

    out = head
    for part in (top, _without(apps, metrics, TOP, "the log has no completed stage"), found,
                 _without(apps, findings, FINDINGS, "nothing stands out"), advised,
                 _without(apps, recs, RECS, "nothing to change")):
        out = out.unionByName(part)
    return out.select(*REPORT_COLUMNS)


def write_report(lines: DataFrame, path: str) -> None:
    """S3: one folder of text per log inside its application's, lines in report order."""
    (lines.withColumn("log", log_folder()).orderBy("app_id", "log", "section", "item", "line_no")
     .select("app_id", "log", "line").write.mode("overwrite").partitionBy("app_id", "log").text(path))

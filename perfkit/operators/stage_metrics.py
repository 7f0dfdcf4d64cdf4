"""Per-stage metrics from parsed tasks and stage records, and the top-stages view.

Rows are first grouped by content (tasks by stage and duration) and written; sums,
exact percentiles and the join to the stage records read that table. No stage is
gathered in one row or one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perfkit.session import written
from perfkit.sources.eventlog import STAGE_FIELDS, stage_rows, with_app_id

STAGE_KEY = ["log_id", "stage_id", "attempt"]
MB = 1024.0 * 1024.0

METRIC_COLUMNS = ["app_id", "stage_id", "attempt", "name", "num_tasks", "stage_duration_ms",
                  "task_p50_ms", "task_p95_ms", "task_max_ms", "skew_ratio_p95_p50",
                  "skew_ratio_max_p50", "gc_pct", "shuffle_read_mb", "shuffle_write_mb", "spill_mb"]


CONTENT_KEY = [*STAGE_KEY, "duration_ms", "stage_rec", "app_rec", "app_ts"]
QUANTILES = {"p50": 0.5, "p95": 0.95}
#: Digits of a duration that a bucket keeps: a stage has 90 buckets for each length, and a bucket
#: of d-digit durations at most 10 ** (d - DIGITS) different ones.
DIGITS = 2


def row_content(rows: DataFrame) -> DataFrame:
    """Equal rows with a repeat count ``n`` and sums of the other metrics.

    Task rows are grouped by stage and duration, stage and start records by their content, so a
    stage with any number of tasks, or a key with any number of records, is spread over many rows.
    """
    return rows.groupBy(*CONTENT_KEY).agg(
        F.count("*").alias("n"), F.sum("gc_time_ms").alias("gc"),
        F.sum("shuffle_read_bytes").alias("read"), F.sum("shuffle_write_bytes").alias("write"),
        F.sum(F.col("spill_mem_bytes") + F.col("spill_disk_bytes")).alias("spill"))


def _bucket(d: Column) -> Column:
    """Ascending with the duration; durations of a bucket share their length and first DIGITS digits."""
    cut = F.greatest(F.lit(0), F.length(d.cast("string")) - DIGITS)
    unit = F.element_at(F.array(*[F.lit(10 ** i).cast("bigint") for i in range(19 - DIGITS + 1)]), cut + 1)
    return cut * 10 ** DIGITS + F.call_function("div", d, unit)


def percentiles(durations: DataFrame) -> DataFrame:
    """A2: exact ``p50`` and ``p95`` (linear interpolation) of ``durations`` (stage key, duration_ms, n),
    one row per duration.

    Two selection passes: running counts over a stage's buckets tell in which buckets the wanted ranks
    lie, and running counts over the durations of those buckets alone tell the values. Neither
    pass sees all durations of a stage at once.
    """
    d = durations.select(*STAGE_KEY, "duration_ms", "n", _bucket(F.col("duration_ms")).alias("bucket"))
    stage = Window.partitionBy(*STAGE_KEY)
    counts = d.groupBy(*STAGE_KEY, "bucket").agg(F.sum("n").alias("n")).select(
        *STAGE_KEY, "bucket", "n",
        (F.sum("n").over(stage.orderBy("bucket")) - F.col("n")).alias("before"), F.sum("n").over(stage).alias("total"))
    at = {k: (F.col("total") - 1) * F.lit(q) for k, q in QUANTILES.items()}
    ranks = F.array(*[f(x).cast("bigint") for x in at.values() for f in (F.floor, F.ceil)])
    within = counts.select(*STAGE_KEY, "bucket", "before", "total", F.filter(
        ranks, lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n"))).alias("ranks"))
    wanted = within.where(F.size("ranks") > 0)
    upto = Window.partitionBy(*STAGE_KEY, "bucket").orderBy("duration_ms")
    found = (d.join(wanted, [*STAGE_KEY, "bucket"])
             .withColumn("last", F.col("before") + F.sum("n").over(upto))
             .withColumn("hit", F.explode(F.filter("ranks", lambda r: (r >= F.col("last") - F.col("n")) & (r < F.col("last"))))))

    def value(rank: Column) -> Column:
        return F.max(F.when(F.col("hit") == rank.cast("bigint"), F.col("duration_ms"))).cast("double")

    def between(x: Column) -> Column:
        low, high = F.floor(x), F.ceil(x)
        return F.when(low == high, value(low)).otherwise((high - x) * value(low) + (x - low) * value(high))

    # total is the same in all rows of a stage; grouping by it keeps it at hand
    return found.groupBy(*STAGE_KEY, "total").agg(*[between(x).alias(k) for k, x in at.items()]).drop("total")


def task_aggregates(content: DataFrame) -> DataFrame:
    """A1-A6 over the task rows of ``row_content``: one row per stage attempt."""
    tasks = content.where(F.col("duration_ms").isNotNull())
    sums = tasks.groupBy(*STAGE_KEY).agg(
        F.max("duration_ms").alias("_max"), F.sum("gc").alias("_gc"),
        F.sum(F.col("duration_ms") * F.col("n")).alias("_dur"), F.sum("read").alias("_read"),
        F.sum("write").alias("_write"), F.sum("spill").alias("_spill"))
    return sums.join(percentiles(tasks), STAGE_KEY)


def _repeated(df: DataFrame, n: str) -> DataFrame:
    """Every row ``n`` times, in steps that keep the made arrays short."""
    step = 1000
    runs = df.withColumn("_run", F.explode(F.sequence(F.lit(0), F.expr(f"({n} - 1) div {step}"))))
    return runs.withColumn("_i", F.explode(F.sequence(
        F.lit(1).cast("bigint"), F.least(F.lit(step).cast("bigint"), F.col(n) - F.col("_run") * step)))).drop("_run", "_i")


def stage_metrics(stages: DataFrame, tasks: DataFrame, apps: DataFrame | None = None) -> DataFrame:
    """One row per stage record, keyed by ``app_id``.

    A stage with no tasks keeps zeros; tasks with no stage record are dropped; a
    repeated stage record yields a repeated row (N6).
    """
    none = {"stage_rec": F.lit(None).cast("string"), "app_rec": F.lit(None).cast("string"),
            "app_ts": F.lit(None).cast("bigint")}
    content = written(row_content(tasks.withColumns(none)), "task-content")
    out = _metric_columns(stages.join(task_aggregates(content), STAGE_KEY, "left"))
    if apps is None:
        return out.withColumn("app_id", F.col("log_id")).select("log_id", *METRIC_COLUMNS)
    return with_app_id(out, apps).select("log_id", *METRIC_COLUMNS)


def _metric_columns(m: DataFrame) -> DataFrame:
    p50 = F.coalesce(F.col("p50"), F.lit(0.0))
    p95 = F.coalesce(F.col("p95"), F.lit(0.0))
    mx = F.coalesce(F.col("_max"), F.lit(0).cast("bigint"))
    dur = F.coalesce(F.col("_dur"), F.lit(0).cast("bigint"))
    sub, comp = F.col("submission_time_ms"), F.col("completion_time_ms")
    return m.select(
        "log_id", "stage_id", "attempt", "name", "num_tasks",
        F.when(sub.isNotNull() & comp.isNotNull(), F.greatest(F.lit(0).cast("bigint"), comp - sub))
         .otherwise(mx).alias("stage_duration_ms"),
        p50.alias("task_p50_ms"), p95.alias("task_p95_ms"), mx.alias("task_max_ms"),
        F.when(p50 > 0, p95 / p50).otherwise(F.lit(0.0)).alias("skew_ratio_p95_p50"),
        F.when(p50 > 0, mx / p50).otherwise(F.lit(0.0)).alias("skew_ratio_max_p50"),
        (F.coalesce(F.col("_gc"), F.lit(0)).cast("double")
         / F.when(dur == 0, F.lit(1)).otherwise(dur).cast("double")).alias("gc_pct"),
        (F.coalesce(F.col("_read"), F.lit(0)) / MB).alias("shuffle_read_mb"),
        (F.coalesce(F.col("_write"), F.lit(0)) / MB).alias("shuffle_write_mb"),
        (F.coalesce(F.col("_spill"), F.lit(0)) / MB).alias("spill_mb"))


def profile_stages(events: DataFrame, materialize: bool = True) -> tuple[DataFrame, DataFrame]:
    """Stage metrics and apps from parsed events with one scan of the logs: ``(metrics, apps)``.

    Tasks, stage records and start records are grouped together by content (``row_content``,
    partial aggregation before the one large shuffle) and written once to the shared folder;
    everything else reads that table. Without ``materialize`` each reader groups them again.
    """
    return profile_from_rows(stage_rows(events), materialize)


def profile_from_rows(rows: DataFrame, materialize: bool = True) -> tuple[DataFrame, DataFrame]:
    """The aggregation behind ``profile_stages``, over ``eventlog.stage_rows`` output
    (live, or as ingested into a table by ``perfkit.streaming``)."""
    content = row_content(rows)
    if materialize:
        content = written(content, "row-content")
    # One row per log (also logs without a start record, N13), with the runtime the
    # logs imply: last stage completion minus first submission, in seconds. The
    # aggregate is partial per task, so a log with very many stages is not gathered.
    apps = content.groupBy("log_id").agg(
        F.max(F.when(F.col("app_rec").isNotNull(), F.struct("app_ts", "app_rec"))).alias("_start"),
        F.min("stage_rec.submission_time_ms").alias("_first"), F.max("stage_rec.completion_time_ms").alias("_last"),
    ).select("log_id", F.coalesce("_start.app_rec.app_id", "log_id").alias("app_id"),
             F.col("_start.app_rec.app_name").alias("app_name"),
             F.expr("(_last - _first) div 1000").alias("runtime_seconds"))
    records = content.where(F.col("stage_rec").isNotNull()).select(
        *STAGE_KEY, "n", *[F.col(f"stage_rec.{k}").alias(k) for k in STAGE_FIELDS])
    out = _metric_columns(_repeated(records.join(task_aggregates(content), STAGE_KEY, "left"), "n"))
    return with_app_id(out, apps).select("log_id", *METRIC_COLUMNS), apps


def top_stages(metrics: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` longest stages of each log (of each application, where ``metrics`` has no
    ``log_id``), with their rank.

    ``row_number() <= n`` is planned as a WindowGroupLimit, which trims every map
    partition to ``n`` rows per log before the shuffle, so a huge
    log does not move all its stages to one task.
    """
    key = [c for c in ("log_id", "app_id") if c in metrics.columns]
    w = Window.partitionBy(*key).orderBy(F.desc("stage_duration_ms"), "stage_id", "attempt")
    return (metrics.withColumn("stage_rank", F.row_number().over(w))
            .where(F.col("stage_rank") <= n))

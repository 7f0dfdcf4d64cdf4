"""Detectors over executed plans: join strategy and file layout (rows of ``sqlplans.node_facts``).

Same columns as the other findings; the evidence also names the query and the plan node. Thresholds
are parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfkit.functions.number_text import fixed
from perfkit.operators.findings import ERROR, WARN, FINDING_COLUMNS, Detector, _evidence, _struct
from perfkit.sources.eventlog import with_app_id

# Finding codes.
MISSED_BROADCAST = "MISSED_BROADCAST"
NESTED_LOOP = "NESTED_LOOP_JOIN"
SMALL_FILES = "SMALL_FILES"
UNSPLITTABLE = "UNSPLITTABLE_FILES"
MB = 1024 * 1024
#: Spark's default of spark.sql.autoBroadcastJoinThreshold.
BROADCAST_BYTES = 10 * MB


def _where(**more: Column) -> Column:
    return _evidence(execution_id=F.col("execution_id"), node_id=F.col("node_id"), **more)


def broadcast_sides() -> Column:
    """The smaller data size among the sides that the join type allows to be broadcast (null: none known)."""
    kind = F.regexp_extract("description", r"\b(Inner|Cross|LeftOuter|RightOuter|FullOuter|LeftSemi|LeftAnti|ExistenceJoin)\b", 1)
    right = F.when(kind.isin("", "Inner", "Cross", "LeftOuter", "LeftSemi", "LeftAnti", "ExistenceJoin"), F.col("right_bytes"))
    left = F.when(kind.isin("", "Inner", "Cross", "RightOuter"), F.col("left_bytes"))
    return F.least(left, right)


def broadcast_detector(heavy_bytes: int = 1024 * MB) -> Detector:
    """A shuffled join with a side under the application's broadcast limit, by its measured size.
    ERROR if the other side shuffled ``heavy_bytes`` or more."""
    small, big = broadcast_sides(), F.greatest("left_bytes", "right_bytes")
    return Detector(
        5, 1, MISSED_BROADCAST,
        F.col("name").isin("SortMergeJoin", "ShuffledHashJoin") & (small <= F.col("broadcast_bytes")),
        F.when(big >= heavy_bytes, F.lit(ERROR)).otherwise(F.lit(WARN)),
        F.format_string("query %d: both sides of a join were shuffled, one had only %d bytes", F.col("execution_id"), small),
        _where(small_bytes=small, other_bytes=big, broadcast_bytes=F.col("broadcast_bytes")))


def nested_loop_detector() -> Detector:
    """A join that compares all pairs; ERROR for a cartesian product."""
    return Detector(
        5, 2, NESTED_LOOP, F.col("name").isin("BroadcastNestedLoopJoin", "CartesianProduct"),
        F.when(F.col("name") == "CartesianProduct", F.lit(ERROR)).otherwise(F.lit(WARN)),
        F.format_string("query %d: %s compares every pair of rows", F.col("execution_id"), F.col("name")),
        _where(output_rows=F.coalesce("output_rows", F.lit(0))))


def small_files_detector(min_files: int = 100, small_mb: float = 32.0) -> Detector:
    """A scan of ``min_files`` files or more that hold under ``small_mb`` MB on average; ERROR from ten times
    as many files on."""
    mean = F.col("file_bytes") / F.col("files") / MB
    return Detector(
        6, 1, SMALL_FILES, (F.col("files") >= min_files) & (mean < small_mb),
        F.when(F.col("files") >= 10 * min_files, F.lit(ERROR)).otherwise(F.lit(WARN)),
        F.format_string("query %d: %d files read with %s MB each", F.col("execution_id"), F.col("files"), fixed(mean, 2)),
        _where(files=F.col("files"), mean_mb=mean))


def unsplittable_detector(split_mb: float = 128.0) -> Detector:
    """A scan whose stage ran no more tasks than files, though these hold over twice a split on average:
    the files were not split."""
    mean = F.col("file_bytes") / F.col("files") / MB
    return Detector(
        6, 2, UNSPLITTABLE,
        (F.col("files") > 0) & (mean > 2 * split_mb) & (F.col("num_tasks") > 0) & (F.col("num_tasks") <= F.col("files")),
        F.lit(WARN),
        F.format_string("query %d: %d files of %s MB were read by %d tasks", F.col("execution_id"), F.col("files"),
                        fixed(mean, 0), F.col("num_tasks")),
        _where(files=F.col("files"), mean_mb=mean, num_tasks=F.col("num_tasks")))


JOIN_DETECTORS = (broadcast_detector, nested_loop_detector)
FILE_DETECTORS = (small_files_detector, unsplittable_detector)


def plan_findings(facts: DataFrame, apps: DataFrame, detectors: list[Detector] | None = None,
                  limits: DataFrame | None = None) -> DataFrame:
    """Findings of ``detectors`` (default: all four) in one pass over ``facts``.

    ``limits`` (app_id, broadcast_bytes) has the applications' broadcast limits; where it has none, or
    one that is not positive (broadcasts switched off), Spark's default counts.
    """
    detectors = detectors or [d() for d in (*JOIN_DETECTORS, *FILE_DETECTORS)]
    df = with_app_id(facts, apps)
    default = F.lit(BROADCAST_BYTES).cast("bigint")
    if limits is None:
        df = df.withColumn("broadcast_bytes", default)
    else:
        own = limits.select("app_id", F.col("broadcast_bytes").alias("_own"))
        df = df.join(own, "app_id", "left").withColumn(
            "broadcast_bytes", F.when(F.col("_own") > 0, F.col("_own")).otherwise(default))
    found = F.filter(F.array(*[F.when(d.when, _struct(d)) for d in detectors]), lambda x: x.isNotNull())
    return df.select("log_id", "app_id", "stage_id", "attempt", F.explode(found).alias("f")).select(
        "log_id", "app_id", "f.detector_seq", "f.code_seq", "f.code", "f.severity", "stage_id", "attempt", "f.message",
        "f.evidence").select(*FINDING_COLUMNS)


def join_findings(facts: DataFrame, apps: DataFrame, limits: DataFrame | None = None) -> DataFrame:
    return plan_findings(facts, apps, [d() for d in JOIN_DETECTORS], limits)


def file_findings(facts: DataFrame, apps: DataFrame) -> DataFrame:
    return plan_findings(facts, apps, [d() for d in FILE_DETECTORS])

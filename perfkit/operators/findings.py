"""Bottleneck detectors: stage metrics (and app settings) -> findings.

Each detector is a condition, a severity expression and the finding's text and
evidence over one metrics row; no detector shuffles. Used alone a detector is a
filter; ``findings_all`` evaluates the four stage detectors in one pass over the
metrics (an array of candidate findings per stage, exploded), so the metrics are
read once, not once per detector. Thresholds are parameters with the reference
defaults.

Finding columns: log_id, app_id, detector_seq, code_seq, code, severity, stage_id, attempt,
message, evidence (map<string,double>). A null ``log_id`` stands for every log of the
application. Within a log ``(detector_seq, stage_id, attempt,
code_seq)`` reproduces the order in which the findings are produced.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfkit.functions.number_text import fixed

FINDING_COLUMNS = ["log_id", "app_id", "detector_seq", "code_seq", "code", "severity", "stage_id",
                   "attempt", "message", "evidence"]

# Finding codes and severities.
SKEW = "SKEW_DETECTED"
SHUFFLE = "SHUFFLE_HEAVY"
SPILL = "SPILL_DETECTED"
GC = "GC_PRESSURE"
OVER = "OVER_PARTITIONED"
UNDER = "UNDER_PARTITIONED"
LOW_PAR = "LOW_DEFAULT_PARALLELISM"
ERROR, WARN, INFO = "ERROR", "WARN", "INFO"


class Detector(NamedTuple):
    detector_seq: int
    code_seq: int
    code: str
    when: Column
    severity: Column
    message: Column
    evidence: Column


def _evidence(**cols: Column) -> Column:
    parts = []
    for k, c in cols.items():
        parts += [F.lit(k), c.cast("double")]
    return F.create_map(*parts)


def _struct(d: Detector) -> Column:
    return F.struct(F.lit(d.detector_seq).alias("detector_seq"), F.lit(d.code_seq).alias("code_seq"),
                    F.lit(d.code).alias("code"), d.severity.alias("severity"),
                    d.message.alias("message"), d.evidence.alias("evidence"))


def with_log(df: DataFrame) -> DataFrame:
    """``df`` with a ``log_id``: null where it has no such column."""
    return df if "log_id" in df.columns else df.withColumn("log_id", F.lit(None).cast("string"))


def _emit(df: DataFrame, d: Detector, stage: bool = True) -> DataFrame:
    return with_log(df).where(d.when).select(
        "log_id", "app_id", F.lit(d.detector_seq).alias("detector_seq"), F.lit(d.code_seq).alias("code_seq"),
        F.lit(d.code).alias("code"), d.severity.alias("severity"),
        (F.col("stage_id") if stage else F.lit(None).cast("bigint")).alias("stage_id"),
        (F.col("attempt") if stage else F.lit(None).cast("bigint")).alias("attempt"),
        d.message.alias("message"), d.evidence.alias("evidence"))


# ------------------------------------------------------------ stage detectors

def skew_detector(p95_p50_warn: float = 3.0, max_p50_warn: float = 8.0, min_tasks: int = 10) -> Detector:
    """Skewed task durations, for stages declaring at least ``min_tasks`` tasks."""
    r95, rmax = F.col("skew_ratio_p95_p50"), F.col("skew_ratio_max_p50")
    return Detector(
        1, 1, SKEW,
        (F.col("num_tasks") >= min_tasks) & ((r95 >= p95_p50_warn) | (rmax >= max_p50_warn)),
        F.when(rmax >= max_p50_warn * 2, F.lit(ERROR)).otherwise(F.lit(WARN)),
        F.format_string("stage %d: slow tail, 95th percentile at %s and slowest task at %s times the median",
                        F.col("stage_id"), fixed(r95, 2), fixed(rmax, 2)),
        _evidence(p95_p50=r95, max_p50=rmax, p50_ms=F.col("task_p50_ms"),
                  p95_ms=F.col("task_p95_ms"), max_ms=F.col("task_max_ms")))


def shuffle_detector(shuffle_mb_warn: float = 1024.0) -> Detector:
    """Shuffle read + write at or above ``shuffle_mb_warn`` MB; ERROR at 5x."""
    total = F.col("shuffle_read_mb") + F.col("shuffle_write_mb")
    return Detector(
        2, 1, SHUFFLE, total >= shuffle_mb_warn,
        F.when(total >= shuffle_mb_warn * 5, F.lit(ERROR)).otherwise(F.lit(WARN)),
        F.format_string("stage %d: %s MB read and written by shuffles", F.col("stage_id"), fixed(total, 0)),
        _evidence(shuffle_read_mb=F.col("shuffle_read_mb"), shuffle_write_mb=F.col("shuffle_write_mb"),
                  spill_mb=F.col("spill_mb")))


def spill_detector(spill_mb_warn: float = 512.0) -> Detector:
    """D3: memory + disk spill at or above ``spill_mb_warn`` MB; ERROR at 5x."""
    spill = F.col("spill_mb")
    return Detector(
        3, 1, SPILL, spill >= spill_mb_warn,
        F.when(spill < spill_mb_warn * 5, F.lit(WARN)).otherwise(F.lit(ERROR)),
        F.format_string("stage %d: %s MB did not fit in memory", F.col("stage_id"), fixed(spill, 0)),
        _evidence(spill_mb=spill))


def gc_detector(gc_pct_warn: float = 0.10) -> Detector:
    """GC share of task time at or above ``gc_pct_warn``; ERROR at 2x."""
    gc = F.col("gc_pct")
    return Detector(
        3, 2, GC, gc >= gc_pct_warn,
        F.when(gc < gc_pct_warn * 2, F.lit(WARN)).otherwise(F.lit(ERROR)),
        F.format_string("stage %d: collector active for %s%% of task time",
                        F.col("stage_id"), fixed(gc * 100, 1)),
        _evidence(gc_pct=gc))


def detect_skew(metrics: DataFrame, p95_p50_warn: float = 3.0, max_p50_warn: float = 8.0,
                min_tasks: int = 10) -> DataFrame:
    return _emit(metrics, skew_detector(p95_p50_warn, max_p50_warn, min_tasks))


def detect_shuffle_heavy(metrics: DataFrame, shuffle_mb_warn: float = 1024.0) -> DataFrame:
    return _emit(metrics, shuffle_detector(shuffle_mb_warn))


def detect_spill_gc(metrics: DataFrame, spill_mb_warn: float = 512.0,
                    gc_pct_warn: float = 0.10) -> DataFrame:
    """D3, D4 are independent: one stage can yield both."""
    return stage_findings(metrics, [spill_detector(spill_mb_warn), gc_detector(gc_pct_warn)])


def default_stage_detectors() -> list[Detector]:
    return [skew_detector(), shuffle_detector(), spill_detector(), gc_detector()]


def stage_findings(metrics: DataFrame, detectors: list[Detector] | None = None) -> DataFrame:
    """All stage detectors in one pass: each metrics row yields 0..n findings."""
    ds = detectors if detectors is not None else default_stage_detectors()
    cand = F.array(*[F.when(d.when, _struct(d)) for d in ds])
    f = with_log(metrics).select("log_id", "app_id", "stage_id", "attempt",
                                 F.explode(F.filter(cand, lambda x: x.isNotNull())).alias("f"))
    return f.select("log_id", "app_id", "f.detector_seq", "f.code_seq", "f.code", "f.severity", "stage_id",
                    "attempt", "f.message", "f.evidence")


# ------------------------------------------------------------ app detectors

def detect_partitioning(settings: DataFrame) -> DataFrame:
    """D5-D7 from ``app_settings`` rows (apps with a valid cluster; null stage)."""
    parts, cores, par = F.col("shuffle_partitions"), F.col("cores_total"), F.col("default_parallelism")
    known = settings.where(cores.isNotNull() & (cores > 0))
    low = F.greatest(F.lit(8).cast("bigint"), F.expr("cores_total div 4"))
    ev = _evidence(shuffle_partitions=parts, cores_total=cores)
    ds = [
        Detector(4, 1, OVER, parts >= cores * 20, F.lit(WARN),
                 F.format_string("%d shuffle partitions planned, cluster runs %d tasks at once",
                                 parts, cores), ev),
        Detector(4, 2, UNDER, parts <= low, F.lit(WARN),
                 F.format_string("%d shuffle partitions planned, too few to fill %d cores", parts, cores), ev),
        Detector(4, 3, LOW_PAR, (par != 0) & (par <= low), F.lit(INFO),
                 F.format_string("RDD stages get %d tasks by default, cluster has %d cores", par, cores),
                 _evidence(default_parallelism=par, cores_total=cores)),
    ]
    cand = F.array(*[F.when(d.when, _struct(d)) for d in ds])
    f = known.select("app_id", F.explode(F.filter(cand, lambda x: x.isNotNull())).alias("f"))
    return f.select(F.lit(None).cast("string").alias("log_id"), "app_id", "f.detector_seq", "f.code_seq", "f.code",
                    "f.severity", F.lit(None).cast("bigint").alias("stage_id"), F.lit(None).cast("bigint").alias("attempt"),
                    "f.message", "f.evidence")


def findings_all(metrics: DataFrame, settings: DataFrame | None = None, apps: DataFrame | None = None) -> DataFrame:
    """Stage findings and (given settings) partitioning findings as one bag.

    With ``apps`` (log_id, app_id) a partitioning finding is given once for each log of its application,
    with a null ``log_id`` where it has none.
    """
    out = stage_findings(metrics)
    if settings is not None:
        planned = detect_partitioning(settings)
        if apps is not None:
            planned = planned.drop("log_id").join(apps.select("app_id", "log_id"), "app_id", "left")
        out = out.unionByName(planned)
    return out


def flat_findings(findings: DataFrame) -> DataFrame:
    """Findings with evidence as one row per key (for tabular output and checks)."""
    return with_log(findings).select("log_id", "app_id", "detector_seq", "code_seq", "code", "severity", "stage_id",
                           "attempt", F.explode("evidence").alias("key", "value"))

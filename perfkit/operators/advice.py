"""Findings -> ranked recommendations (R1-R7, J2, J3, T5) and their JSON sink.

The rules are a table of eleven rows joined by code with a broadcast hint (its size is
fixed by the number of codes). Two skew actions are swapped when the
application's conf already enables AQE or skew-join handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfkit.functions.number_text import json_map
from perfkit.operators import findings as fd
from perfkit.operators import plan_findings as pf
from perfkit.operators.ranking import rank_within
from perfkit.sources.conf import conf_typed
from perfkit.sources.eventlog import log_folder

RULE_SCHEMA = T.StructType([
    T.StructField("code", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("rationale", T.StringType()), T.StructField("actions", T.ArrayType(T.StringType())),
    T.StructField("aqe_idx", T.IntegerType()), T.StructField("aqe_alt", T.StringType()),
    T.StructField("skew_idx", T.IntegerType()), T.StructField("skew_alt", T.StringType()),
])

# Fixed by the interface: the codes, how many actions each has, and that the second and third
# action of the skew rule have another text where adaptive execution or its skew join is on.
RULES = [
    (fd.SKEW, "Even out the largest tasks",
     "The stage ends when its largest partition does; the other cores have nothing left to run by then.",
     ["Count rows per key on this stage's input; treat null or placeholder keys separately if they lead the list.",
      "Let the runtime re-plan after each shuffle: spark.sql.adaptive.enabled=true.",
      "Let oversized join partitions be cut into pieces: spark.sql.adaptive.skewJoin.enabled=true.",
      "Add a salt column to the grouping, aggregate by key and salt, then aggregate once more by key alone."],
     1, "The runtime already re-plans: compare the final plan with the initial one to see which step stays uneven.",
     2, "Oversized join partitions are already cut: lower skewedPartitionFactor or its byte threshold so that "
        "this one qualifies, or check whether the uneven step is an aggregation, which is not cut."),
    (fd.SHUFFLE, "Send fewer bytes between stages",
     "Every shuffled byte is serialised, written to local disk and fetched over the network by another task.",
     ["Select the needed columns and filter rows before the wide step, not after it.",
      "Store tables that are often joined on one key bucketed by it, so that the join reads them in place.",
      "Check for an exchange that appears twice in the plan on the same keys; one repartition can serve both.",
      "Replace a join that only tests for existence by a semi join on the distinct keys."],
     None, None, None, None),
    (fd.SPILL, "Fit each task's sort and hash tables in memory",
     "Rows that do not fit are written to disk and merged again, several times over for large partitions.",
     ["Divide the stage's shuffle bytes by 128 MB and use at least that many shuffle partitions.",
      "Run fewer tasks at once per executor (spark.executor.cores) so that each has a larger share.",
      "Look for collect_list, wide windows or exploded arrays that hold a whole group in one buffer."],
     None, None, None, None),
    (fd.GC, "Create fewer objects on the heap",
     "The collector runs while tasks wait; its share grows with live objects rather than with bytes read.",
     ["Release cached tables that no later stage reads, or cache them serialised.",
      "Replace typed lambdas over case classes or rows by column expressions, which work on binary rows.",
      "Compare a smaller heap per executor with more executors; very large heaps pause longer."],
     None, None, None, None),
    (fd.OVER, "Plan larger shuffle partitions",
     "With far more partitions than cores the driver spends its time on launching tasks and tracking map output.",
     ["Start from the shuffled volume: partitions of 100 to 200 MB suit most stages.",
      "Set spark.sql.adaptive.advisoryPartitionSizeInBytes and let small partitions be merged at run time.",
      "Watch the number of files that the last stage writes; it equals its number of tasks."],
     None, None, None, None),
    (fd.UNDER, "Plan smaller shuffle partitions",
     "With fewer partitions than cores some cores stay empty in every wide stage, however long it runs.",
     ["Choose a multiple of the total cores, so that the last wave of tasks is a full one.",
      "Set spark.sql.adaptive.coalescePartitions.initialPartitionNum high and leave the merging to the runtime."],
     None, None, None, None),
    (fd.LOW_PAR, "Widen RDD stages",
     "RDD operations without an explicit partition count inherit this value, whatever the size of the cluster.",
     ["Pass numPartitions to the RDD operations that matter, or raise the setting to a few tasks per core.",
      "Move the step to DataFrames, which ignore this setting."],
     None, None, None, None),
]

# Rules for the findings on executed plans.
PLAN_RULES = [
    (pf.MISSED_BROADCAST, "Send the small side of the join to every executor",
     "A side this small can be copied instead; then the large side need not be shuffled and sorted at all.",
     ["Collect table statistics (ANALYZE TABLE), so that the planner knows the size before it runs.",
      "Keep adaptive execution on: it turns such joins into broadcasts once the shuffle's size is known.",
      "Add a broadcast hint where the size is certain to stay small."],
     None, None, None, None),
    (pf.NESTED_LOOP, "Give the join an equality condition",
     "Without one every row is compared with every other, and the work grows with the product of both sides.",
     ["Look for a missing or mistyped join condition, or one under OR, which hides its equalities.",
      "Turn a range condition into an equality on a bucket of the range, and check the range afterwards."],
     None, None, None, None),
    (pf.SMALL_FILES, "Write fewer, larger files",
     "Each file costs a listing, an open and a footer; with small files these take longer than the data.",
     ["Rewrite the table with files of 128 MB to 1 GB, and do so again whenever many small ones have gathered.",
      "Let the writing job merge its last partitions, or repartition by the folder columns before the write."],
     None, None, None, None),
    (pf.UNSPLITTABLE, "Store the files in a form that can be split",
     "A file that can't be split is read by one task from start to end, however many cores are free.",
     ["Replace gzip text by Parquet, or by a compression that can be cut into blocks.",
      "Until then, have the producer write more and smaller files."],
     None, None, None, None),
]

# Severity order for ranking (anything else ranks last).
SEVERITY_RANK = {"ERROR": 0, "WARN": 1, "INFO": 2}
OTHER_RANK = 9


def rules_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES + PLAN_RULES, RULE_SCHEMA)


def severity_rank(col: str = "severity"):
    c = F.col(col)
    out = F.when(c == "ERROR", SEVERITY_RANK["ERROR"])
    for k in ("WARN", "INFO"):
        out = out.when(c == k, SEVERITY_RANK[k])
    return out.otherwise(OTHER_RANK)


def recommend(findings: DataFrame, confs: DataFrame | None = None) -> DataFrame:
    """One recommendation per finding whose code has a rule.

    ``rec_seq`` numbers the recommendations of a log (of an application, where the log is null) by severity, then stage
    (null last), then the order the findings were produced in. The numbering is a
    global sort plus per-task offsets (``ranking.rank_within``), so a log
    with very many findings is not ranked inside a single task.
    """
    spark = findings.sparkSession
    rules = F.broadcast(rules_table(spark))
    f = fd.with_log(findings).join(rules, "code", "inner")
    if confs is not None:
        flags = conf_typed(confs).select("app_id", "aqe_enabled", "skew_join_enabled")
        f = f.join(flags, "app_id", "left")
    else:
        f = f.withColumn("aqe_enabled", F.lit(None).cast("boolean")) \
             .withColumn("skew_join_enabled", F.lit(None).cast("boolean"))
    aqe = F.coalesce(F.col("aqe_enabled"), F.lit(False))
    skew = F.coalesce(F.col("skew_join_enabled"), F.lit(False))
    actions = F.transform("actions", lambda a, i: (
        F.when(aqe & (i == F.col("aqe_idx")), F.col("aqe_alt"))
         .when(skew & (i == F.col("skew_idx")), F.col("skew_alt"))
         .otherwise(a)))
    n_adj = (F.when(aqe & F.col("aqe_idx").isNotNull(), 1).otherwise(0)
             + F.when(skew & F.col("skew_idx").isNotNull(), 1).otherwise(0))
    order = [severity_rank(), F.asc_nulls_last("stage_id"), F.col("detector_seq"), F.col("attempt"),
             F.col("code_seq")]
    out = f.select(
        "log_id", "app_id", F.coalesce("log_id", "app_id").alias("_of"), "code", "severity", "title", "rationale", actions.alias("actions"),
        "stage_id", "attempt", "evidence", n_adj.alias("n_adjusted"),
        "detector_seq", "code_seq",
    )
    return rank_within(out, "_of", order, "rec_seq").drop("_of")


def recommendations_json(recs: DataFrame) -> DataFrame:
    """One JSON object per recommendation, ``(log_id, app_id, rec_seq, json)``.

    One object per row (JSON lines) rather than one array per application, so no
    application's output is gathered into a single row. Numbers of the evidence are written with
    one to six decimals (``number_text.json_map``), the other fields by ``to_json``.
    """
    obj = F.to_json(F.struct("severity", "title", "stage_id", "rationale", "actions"), {"ignoreNullFields": "false"})
    evidence = F.coalesce(json_map(F.col("evidence")), F.lit("null"))
    opened = obj.substr(F.lit(1), F.length(obj) - 1)  # without the closing brace
    return recs.select("log_id", "app_id", "rec_seq", F.concat(opened, F.lit(',"evidence":'), evidence, F.lit("}")).alias("json"))


def write_recommendations(recs: DataFrame, path: str) -> None:
    """Write JSON lines, one folder per log inside its application's, in rank order."""
    (recommendations_json(recs).withColumn("log", log_folder()).orderBy("app_id", "log", "rec_seq")
     .select("app_id", "log", "json").write.mode("overwrite").partitionBy("app_id", "log").text(path))

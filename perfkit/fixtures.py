"""Inputs derived from the driver's tables (FIXTURES.md), built with Spark.

The profile inputs are real JSON event-log lines made from ``lineitem`` (one task
per row) and ``supplier``; configuration files and cluster sizes come from
``nation``. The retrieval inputs come from ``embeddings`` and ``documents``.
Everything here grows with the tables it reads.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perfkit.session import checkpoint_dir, path_exists, path_stamp


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _pick(key: Column, mod: int, first: int, second: int, rest: int) -> Column:
    """``first`` when key % mod = 0, ``second`` when it is 1, else ``rest``."""
    return F.when(key % mod == 0, first).when(key % mod == 1, second).otherwise(rest)


def fixture_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``f_tasks``: one synthetic task per lineitem row (FIXTURES §3)."""
    li = table(spark, sf_dir, "lineitem")
    s, q = F.col("l_suppkey"), F.col("l_quantity")
    base = F.floor("l_extendedprice").cast("bigint")
    mult = (F.when((s % 5 == 0) & (q >= 49), 20).when((s % 5 == 1) & (q >= 46), 5).otherwise(1))
    launch = F.expr("timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', l_shipdate)")
    t = li.select(
        F.concat(F.lit("app-"), (s % 25).cast("string")).alias("app_id"),
        s.alias("stage_id"),
        (F.col("l_linenumber") % 2).cast("bigint").alias("attempt"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("task_id"),
        (F.col("l_orderkey") % 2 == 1).alias("id_spelling"),
        base.alias("base"), (base * mult).alias("dur"), launch.alias("launch"),
        ((F.col("l_returnflag") == "R") & (q < 5)).alias("no_finish"),
        (F.floor(base * F.col("l_tax")).cast("bigint") * _pick(s, 7, 7, 4, 1)).alias("gc"),
        (base * _pick(s, 4, 60, 300, 6)).alias("remote"),
        (base * _pick(s, 4, 40, 100, 4)).alias("local"),
        (base * _pick(s, 4, 50, 100, 5)).alias("write"),
        (base * _pick(s, 6, 40, 200, 1)).alias("spill_mem"),
        (base * _pick(s, 6, 10, 50, 0)).alias("spill_disk"))
    return t.withColumn("finish", F.when(~F.col("no_finish"), F.col("launch") + F.col("dur"))) \
            .withColumn("run", F.col("base"))


def fixture_stages(spark: SparkSession, sf_dir: str, tasks: DataFrame | None = None) -> DataFrame:
    """``f_stages``: one row per task stage attempt, plus task-less stages per supplier."""
    t = tasks if tasks is not None else fixture_tasks(spark, sf_dir)
    sid = F.col("stage_id")
    g = t.groupBy("app_id", "stage_id", "attempt").agg(
        F.count("*").alias("n"), F.min("launch").alias("first_launch"),
        F.max(F.coalesce("finish", F.col("launch") + F.col("run"))).alias("completed"))
    st = g.select(
        "app_id", "stage_id", "attempt",
        F.when(sid % 10 == 6, F.lit(5).cast("bigint")).otherwise(F.col("n")).alias("num_tasks"),
        F.when(sid % 9 == 4, F.lit(None).cast("bigint")).otherwise(F.col("first_launch")).alias("submitted"),
        F.col("completed"))
    su = table(spark, sf_dir, "supplier").where(F.col("s_suppkey") % 5 == 0)
    empty = su.select(
        F.concat(F.lit("app-"), (F.col("s_suppkey") % 25).cast("string")).alias("app_id"),
        (F.col("s_suppkey") + 1000000).alias("stage_id"), F.lit(0).cast("bigint").alias("attempt"),
        F.lit(20).cast("bigint").alias("num_tasks"), F.lit(None).cast("bigint").alias("submitted"),
        F.lit(None).cast("bigint").alias("completed"))
    return st.unionByName(empty).withColumn("name", F.concat(F.lit("stage "), sid.cast("string")))


def _log_id(app_id: Column) -> Column:
    return app_id


#: Lines that are rejected, of the applications whose number mod 5 is 0, 1 and 2.
CUT_LINES = ('{"Event":"SparkListenerTaskEnd","Stage ID":', '{"Event":"SparkListenerTa',
             '{"Event":"SparkListenerTaskEnd","Stage ID":"seven"}')


def eventlog_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON event-log lines ``(log_id, value)`` for every fixture application;
    ``log_id`` here is the log's folder name (the application id).

    Odd order keys (tasks), odd stage ids (stages) and odd application numbers use
    the ``Id`` key spelling; absent finish times are left out of the JSON. Each log
    also carries a stale start record (older timestamp, must lose), an unrelated
    event kind, a blank line and, for some logs, a line cut in its fields, a line cut in its
    event name or an event whose stage is no number. Every seventh task has its numbers quoted
    or with a fraction, every seventh stage too.
    """
    tasks = fixture_tasks(spark, sf_dir)
    stages = fixture_stages(spark, sf_dir, tasks)

    def task_json(sp: str, odd: bool = False) -> Column:
        stage = F.col("stage_id").cast("string") if odd else F.col("stage_id")
        launch, finish, gc = (F.col(c).cast("decimal(20,1)") if odd else F.col(c) for c in ("launch", "finish", "gc"))
        return F.to_json(F.struct(
            F.lit("SparkListenerTaskEnd").alias("Event"),
            stage.alias(f"Stage {sp}"), F.col("attempt").alias(f"Stage Attempt {sp}"),
            F.struct(F.col("task_id").alias(f"Task {sp}"), launch.alias("Launch Time"),
                     finish.alias("Finish Time")).alias("Task Info"),
            F.struct(F.col("run").alias("Executor Run Time"), gc.alias("JVM GC Time"),
                     F.col("spill_mem").alias("Memory Bytes Spilled"),
                     F.col("spill_disk").alias("Disk Bytes Spilled"),
                     F.struct(F.col("remote").alias("Remote Bytes Read"),
                              F.col("local").alias("Local Bytes Read")).alias("Shuffle Read Metrics"),
                     F.struct(F.col("write").alias("Shuffle Bytes Written")).alias("Shuffle Write Metrics"),
                     ).alias("Task Metrics")))

    task_lines = tasks.select(
        _log_id(F.col("app_id")).alias("log_id"),
        F.when(F.col("task_id") % 7 == 0, task_json("ID", odd=True))
         .when(F.col("id_spelling"), task_json("Id")).otherwise(task_json("ID")).alias("value"))

    def stage_json(sp: str, odd: bool = False) -> Column:
        n = F.col("num_tasks").cast("string") if odd else F.col("num_tasks")
        return F.to_json(F.struct(
            F.lit("SparkListenerStageCompleted").alias("Event"),
            F.struct(F.col("stage_id").alias(f"Stage {sp}"), F.col("attempt").alias(f"Stage Attempt {sp}"),
                     F.col("name").alias("Stage Name"), n.alias("Number of Tasks"),
                     F.col("submitted").alias("Submission Time"),
                     F.col("completed").alias("Completion Time")).alias("Stage Info")))

    stage_lines = stages.select(
        _log_id(F.col("app_id")).alias("log_id"),
        F.when(F.col("stage_id") % 7 == 0, stage_json("ID", odd=True))
         .when(F.col("stage_id") % 2 == 1, stage_json("Id")).otherwise(stage_json("ID")).alias("value"))

    apps = fixture_apps(spark, sf_dir)

    def start_json(sp: str, name: Column, ts: Column) -> Column:
        return F.to_json(F.struct(F.lit("SparkListenerApplicationStart").alias("Event"),
                                  name.alias("App Name"), F.col("app_id").alias(f"App {sp}"),
                                  ts.alias("Timestamp")))

    odd = F.col("app_no") % 2 == 1
    name = F.concat(F.lit("job-"), F.col("app_no").cast("string"))
    start = apps.select(_log_id(F.col("app_id")).alias("log_id"),
                        F.when(odd, start_json("Id", name, F.lit(2000)))
                         .otherwise(start_json("ID", name, F.lit(2000))).alias("value"))
    stale = apps.select(_log_id(F.col("app_id")).alias("log_id"),
                        start_json("ID", F.lit("stale-name"), F.lit(1000)).alias("value"))
    noise = apps.select(_log_id(F.col("app_id")).alias("log_id"), F.explode(F.array(
        F.lit('{"Event":"SparkListenerExecutorAdded","Executor ID":"1"}'),
        F.lit("   "),
        F.when(F.col("app_no") % 5 == 0, F.lit(CUT_LINES[0]))
         .when(F.col("app_no") % 5 == 1, F.lit(CUT_LINES[1]))
         .when(F.col("app_no") % 5 == 2, F.lit(CUT_LINES[2]))
    )).alias("value")).where(F.col("value").isNotNull())
    return start.unionByName(stale).unionByName(stage_lines).unionByName(task_lines).unionByName(noise)


def fixture_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One application per distinct ``s_suppkey % 25``: ``(app_no, app_id, log_id)``."""
    su = table(spark, sf_dir, "supplier")
    return (su.select((F.col("s_suppkey") % 25).alias("app_no")).distinct()
            .select("app_no", F.concat(F.lit("app-"), F.col("app_no").cast("string")).alias("app_id")))


def conf_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configuration file per nation as ``(app_id, json)`` text (FIXTURES §3), and a cut one for
    every sixth nation under ``cut-<nation>``."""
    n = F.col("n_nationkey")

    def kv(k: str, v: str) -> Column:
        return F.struct(F.lit(k).alias("k"), F.lit(v).alias("v"))

    sp, dp = "spark.sql.shuffle.partitions", "spark.default.parallelism"
    aqe, skew = "spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"
    entries = F.array(
        F.when(n % 4 == 1, kv(sp, "2000")).when(n % 4 == 2, kv(sp, "8")).when(n % 4 == 3, kv(sp, "abc")),
        F.when(n % 3 == 1, kv(dp, "4")).when(n % 3 == 2, kv(dp, "64")),
        F.when(n % 2 == 0, kv(aqe, " TRUE ")).otherwise(kv(aqe, "0")),
        F.when(n % 5 == 0, kv(skew, "yes")).when(n % 5 == 1, kv(skew, "maybe")))
    kv = F.filter(entries, lambda e: e.isNotNull())
    m = F.map_from_entries(kv)
    nations = table(spark, sf_dir, "nation")
    cut = nations.where(n % 6 == 0).select(F.concat(F.lit("cut-"), n.cast("string")).alias("app_id"),
                                           F.lit('{"spark.sql.shuffle.partitions": "20').alias("json"))
    return nations.select(
        F.concat(F.lit("app-"), n.cast("string")).alias("app_id"), F.to_json(m).alias("json")).unionByName(cut)


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cluster row per nation; nation 24 has zero nodes and is rejected."""
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("app-"), n.cast("string")).alias("app_id"),
        F.when(n == 24, F.lit(0)).otherwise(1 + n % 10).cast("int").alias("nodes"),
        F.lit(4).alias("cores_per_node"), F.lit(16.0).alias("memory_gb_per_node"),
        F.lit(0.45).alias("rate_per_node_hour"), F.lit(0.15).alias("rate_per_dbu_hour"),
        F.when(n % 3 != 0, F.lit(2.0)).otherwise(F.lit(0.0)).alias("dbus_per_node"))


def cost_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current and optimized scenarios per nation application."""
    n = F.col("n_nationkey")
    cur = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("app-"), n.cast("string")).alias("app_id"),
        (n * 600 - 300).cast("bigint").alias("runtime_seconds"),
        F.when(n == 24, F.lit(0)).otherwise(1 + n % 10).cast("bigint").alias("nodes"),
        F.lit(0.45).alias("rate_per_node_hour"),
        F.when(n % 3 != 0, F.lit(2.0)).otherwise(F.lit(0.0)).alias("dbus_per_node"),
        F.lit(0.15).alias("rate_per_dbu_hour"))
    opt = cur.select(
        "app_id", F.expr("runtime_seconds * 7 div 10").alias("runtime_seconds"),
        F.expr("CASE WHEN nodes div 2 = 0 THEN 1 ELSE nodes div 2 END").cast("bigint").alias("nodes"),
        "rate_per_node_hour", "dbus_per_node", "rate_per_dbu_hour")
    return (cur.withColumn("scenario", F.lit("current"))
            .unionByName(opt.withColumn("scenario", F.lit("optimized"))))


#: Form of the fixture files: files of another form are not read again.
FORM = 3
#: Lines of one file of a log: a compressed file is read as a whole.
LINES_PER_FILE = 20_000
#: Files that a task writes at a time; one per log, so that lines need not be sorted by log.
OPEN_FILES = 64


def _source_key(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> str:
    h = hashlib.sha1(f"{FORM}:{sf_dir.rstrip('/')}".encode())
    for n in names:
        h.update(f"{n}:{path_stamp(spark, os.path.join(sf_dir, f'{n}.parquet'))}".encode())
    return h.hexdigest()[:16]


def _complete(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, os.path.join(path, "_SUCCESS"))


def made_once(spark: SparkSession, sf_dir: str, sources: tuple[str, ...], name: str,
              make: Callable[[], DataFrame]) -> DataFrame:
    """The table ``make`` gives, written under the shared folder once and read while the source tables
    are unchanged."""
    path = os.path.join(checkpoint_dir(spark), "fixtures", _source_key(spark, sf_dir, sources), name)
    if not _complete(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _write_logs(lines: DataFrame, path: str) -> None:
    """One folder of compressed files per log. Lines are wide and the logs few: a task keeps a file of each
    open (only from the log beyond OPEN_FILES on does it sort), so none are spilled."""
    conf, key = lines.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(key, None)
    conf.set(key, str(OPEN_FILES))
    try:
        (lines.withColumnRenamed("log_id", "log").write.mode("overwrite").partitionBy("log")
         .option("maxRecordsPerFile", LINES_PER_FILE).option("zlib.compress.level", "BEST_SPEED")
         .text(path, compression="gzip"))
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def profile_files(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Write the fixture event logs and conf files once, under the shared checkpoint
    folder, and return their paths.

    Layout: ``eventlogs/log=<app>/part-*`` (a rolled log: one folder per
    application, any number of files) and ``confs/<app>/part-*`` (one JSON object
    per file). Re-used while the source tables are unchanged.
    """
    base = os.path.join(checkpoint_dir(spark), "fixtures",
                        _source_key(spark, sf_dir, ("lineitem", "supplier", "nation")))
    logs, confs = os.path.join(base, "eventlogs"), os.path.join(base, "confs")
    if not _complete(spark, logs):
        _write_logs(eventlog_lines(spark, sf_dir), logs)
    if not _complete(spark, confs):
        (conf_json(spark, sf_dir).select(F.col("app_id").alias("app"), F.col("json"))
         .write.mode("overwrite").partitionBy("app").text(confs))
    return {"eventlogs": logs, "confs": confs}


def fixture_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One SQL query per customer (FIXTURES §3b): a join of two shuffled scans. ``t`` is the sum of the
    prices of the customer's orders, ``n`` their number."""
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.floor(F.sum(F.col("o_totalprice").cast("decimal(15,2)"))).cast("bigint").alias("t"))
    c = table(spark, sf_dir, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    k, n = F.col("c_custkey"), F.coalesce(F.col("n"), F.lit(0))
    whole = k % 7 == 3
    files = F.when(whole, n).otherwise(n * 50)
    return c.select(
        F.concat(F.lit("app-"), (k % 25).cast("string")).alias("app_id"), k.alias("q"),
        (F.coalesce("t", F.lit(0)) * 1000).cast("bigint").alias("left_bytes"),
        ((F.floor("c_acctbal").cast("bigint") + 1000) * 2000).alias("right_bytes"), files.cast("bigint").alias("files"),
        (files * F.when(whole, 512 * MB).when(k % 5 == 0, MB).otherwise(64 * MB)).cast("bigint").alias("file_bytes"),
        F.when(whole, n).otherwise(n * 100).cast("bigint").alias("tasks"), (n * n).cast("bigint").alias("rows"))


MB = 1 << 20
#: The join of a query by its number mod 8: node and join type; the adaptive plan of the last turns it into a broadcast join.
QUERY_JOINS = (("SortMergeJoin", "Inner"), ("SortMergeJoin", "Inner"), ("ShuffledHashJoin", "RightOuter"),
               ("SortMergeJoin", "LeftOuter"), ("SortMergeJoin", "FullOuter"), ("BroadcastNestedLoopJoin", "Cross"),
               ("CartesianProduct", ""), ("SortMergeJoin", "Inner"))


def sql_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(log_id, value)`` of the queries of ``fixture_queries``: start, one or two re-plans, driver
    updates and three stages each. Accumulators of query q are q * 100 + i; its stages q * 10 + 1 (left
    scan), + 2 (right scan) and + 3 (join)."""
    qs = fixture_queries(spark, sf_dir)
    q = F.col("q")

    def node(name: Column, text: Column, metrics: list, inputs: list) -> Column:
        pair = [F.struct(F.lit(m).alias("name"), (q * 100 + i).alias("accumulatorId"), F.lit("sum").alias("metricType"))
                for m, i in metrics]
        parts = [F.lit('{"nodeName":'), F.to_json(F.array(name)), F.lit(',"simpleString":'), F.to_json(F.array(text)),
                 F.lit(',"metadata":{},"metrics":'), F.to_json(F.array(*pair)) if pair else F.lit("[]"),
                 F.lit(',"children":[')]
        for i, c in enumerate(inputs):
            parts += [F.lit(","), c] if i else [c]
        text = F.concat(*parts, F.lit("]}"))
        # to_json of an array of one string: the brackets go
        return F.regexp_replace(text, r'"(nodeName|simpleString)":\[("(?:[^"\\\\]|\\\\.)*")\]', '"$1":$2')

    def side(i: int) -> Column:
        scan = node(F.lit("Scan parquet t"), F.lit("FileScan parquet [k#1] Batched: true"),
                    [("number of files read", i), ("size of files read", i + 1), ("number of output rows", i + 2)], [])
        exchange = node(F.lit("Exchange"), F.lit("Exchange hashpartitioning(k#1, 200)"), [("data size", i + 3)], [scan])
        return node(F.lit("Sort"), F.lit("Sort [k#1 ASC]"), [], [node(F.lit("ShuffleQueryStage"), F.lit("ShuffleQueryStage 0"), [], [exchange])])

    def plan(name: Column, kind: Column, final: bool, first: int) -> Column:
        text = F.concat_ws(" ", name, F.lit("[k#1], [k#2],"), kind)
        join = node(name, text, [("number of output rows", first)], [side(10), side(20)])
        return node(F.lit("AdaptiveSparkPlan"), F.lit(f"AdaptiveSparkPlan isFinalPlan={str(final).lower()}"), [], [join])

    at = (q % 8).cast("int") + 1
    name = F.element_at(F.array(*[F.lit(n) for n, _ in QUERY_JOINS]), at)
    kind = F.element_at(F.array(*[F.lit(t) for _, t in QUERY_JOINS]), at)
    last = F.when(at == 8, F.lit("BroadcastHashJoin")).otherwise(name)

    def event(kind: str, *parts: Column) -> Column:
        return F.concat(F.lit('{"Event":"org.apache.spark.sql.execution.ui.' + kind + '","executionId":'), q.cast("string"),
                        *parts, F.lit("}"))

    def with_plan(kind: str, p: Column) -> Column:
        return event(kind, F.lit(',"physicalPlanDescription":"","sparkPlanInfo":'), p)

    updates = F.to_json(F.array(*[F.array(q * 100 + i, v) for i, v in (
        (10, F.col("files")), (11, F.col("file_bytes")), (20, F.lit(1).cast("bigint")), (21, F.lit(MB).cast("bigint")))]))

    def stage(i: int, tasks: Column, values: list) -> Column:
        acc = F.array(*[F.struct((q * 100 + a).alias("ID"), F.lit(n).alias("Name"), v.cast("string").alias("Value"))
                        for a, n, v in values], F.struct(F.lit(7).cast("bigint").alias("ID"), F.lit("internal.metrics.peak").alias("Name"), F.lit("9").alias("Value")))
        return F.to_json(F.struct(F.lit("SparkListenerStageCompleted").alias("Event"), F.struct(
            (q * 10 + i).alias("Stage ID"), F.lit(0).alias("Stage Attempt ID"), tasks.alias("Number of Tasks"),
            acc.alias("Accumulables")).alias("Stage Info")))

    one = F.lit(1).cast("bigint")
    lines = F.array(
        with_plan("SparkListenerSQLExecutionStart", plan(F.lit("SortMergeJoin"), F.lit("Inner"), False, 1)),
        F.when(q % 3 == 0, with_plan("SparkListenerSQLAdaptiveExecutionUpdate", plan(F.lit("SortMergeJoin"), F.lit("Inner"), False, 2))),
        with_plan("SparkListenerSQLAdaptiveExecutionUpdate", plan(last, kind, True, 3)),
        event("SparkListenerDriverAccumUpdates", F.lit(',"accumUpdates":'), updates),
        stage(1, F.col("tasks"), [(12, "number of output rows", F.col("rows")), (13, "data size", F.col("left_bytes"))]),
        stage(2, one, [(22, "number of output rows", F.col("rows")), (23, "data size", F.col("right_bytes"))]),
        stage(3, F.lit(200).cast("bigint"), [(3, "number of output rows", F.col("rows") * 2)]))
    queries = qs.select(F.col("app_id").alias("log_id"), F.explode(F.filter(lines, lambda x: x.isNotNull())).alias("value"))
    starts = qs.select("app_id").distinct().select(F.col("app_id").alias("log_id"), F.to_json(F.struct(
        F.lit("SparkListenerApplicationStart").alias("Event"), F.lit("sql").alias("App Name"),
        F.col("app_id").alias("App ID"), F.lit(1).alias("Timestamp"))).alias("value"))
    return starts.unionByName(queries)


def sql_files(spark: SparkSession, sf_dir: str) -> str:
    """The folder of ``sql_lines``, written once like the other logs."""
    path = os.path.join(checkpoint_dir(spark), "fixtures", _source_key(spark, sf_dir, ("customer", "orders")), "sqllogs")
    if not _complete(spark, path):
        _write_logs(sql_lines(spark, sf_dir), path)
    return path


# ------------------------------------------------------------------ retrieval

# Fixture versions. Dense: outputs of the projection (of the source width: the vector).
# Text: number of hash buckets.
DENSE_WIDTH = 64
DENSE_VERSIONS = {"v1": 64, "v2": 8, "v3": 32}
TEXT_VERSIONS = {"v1": 384, "v2": 64, "v3": 1024}


def dense_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, embedding)`` from ``embeddings``."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")


def dense_golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Golden queries ``(qid, query_vec, expected_doc_id)``: every hundredth vector (by id) plus
    0.9 times its successor (the successor may be absent: then the vector alone)."""
    e = table(spark, sf_dir, "embeddings")
    g = e.where(F.col("vec_id") % 100 == 0).select("vec_id", F.col("embedding").alias("own"))
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("nxt"))
    j = g.join(nxt, "vec_id", "left")
    q = F.when(F.col("nxt").isNull(), F.transform("own", lambda x: x.cast("double"))).otherwise(
        F.zip_with("own", "nxt", lambda x, y: x.cast("double") + F.lit(0.9) * y.cast("double")))
    return j.select(F.col("vec_id").alias("qid"), q.alias("query_vec"),
                    F.col("vec_id").alias("expected_doc_id"))


def text_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)`` from ``documents``."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def text_golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Golden queries ``(qid, query, expected_doc_id)``: the whole text of every document
    whose id is divisible by 100."""
    d = table(spark, sf_dir, "documents").where((F.col("doc_id") % 100 == 0) & F.col("text").isNotNull())
    return d.select(F.col("doc_id").alias("qid"), F.col("text").alias("query"),
                    F.col("doc_id").alias("expected_doc_id"))

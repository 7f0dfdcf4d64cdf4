"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (or data Spark derives from them) in full.
Outputs are flat scalar columns; doubles are rounded to 6 decimals so the DuckDB
oracle in ``perfkit.oracle`` can be compared value for value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfkit import fixtures as fx
from perfkit.operators import advice as adv
from perfkit.operators import cost as co
from perfkit.operators import embed as em
from perfkit.operators import evaluate as evl
from perfkit.operators import findings as fd
from perfkit.operators import plan_findings as pf
from perfkit.operators import search as se
from perfkit.operators import versions as vs
from perfkit.plans import lifecycle as lc
from perfkit.operators import report as rp
from perfkit.operators.stage_metrics import profile_from_rows, profile_stages, top_stages
from perfkit.sources import conf as cf
from perfkit.sources import eventlog as ev
from perfkit.sources import sqlplans as sq
from perfkit.sources.registry import Registry
from perfkit.session import scratch_path

R = 6  # decimals kept in checked outputs


def _r(c: str) -> F.Column:
    return F.round(F.col(c), R).alias(c)


# ---------------------------------------------------------------- profile inputs

def profile_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    files = fx.profile_files(spark, sf_dir)
    lines = ev.read_eventlog(spark, files["eventlogs"], rolled=True)
    events = ev.parse_events(lines)
    apps = ev.parse_apps(ev.parse_events(lines, (ev.APP_START,)))
    stages = ev.parse_stages(events)
    tasks = ev.parse_tasks(events)
    confs = cf.read_confs(spark, files["confs"], by="dir")
    clusters = fx.clusters(spark, sf_dir)
    return dict(lines=lines, events=events, apps=apps, stages=stages, tasks=tasks,
                confs=confs, clusters=clusters)


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_stages(profile_inputs(spark, sf_dir)["events"])[0]


def _settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = profile_inputs(spark, sf_dir)
    return cf.app_settings(p["confs"], p["clusters"])


def _findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = profile_inputs(spark, sf_dir)
    m, apps = profile_stages(p["events"])
    return fd.findings_all(m, cf.app_settings(p["confs"], p["clusters"]), apps)


def _finding_rows(f: DataFrame) -> DataFrame:
    return f.select("app_id", "detector_seq", "code_seq", "code", "severity", "stage_id", "attempt",
                    F.size(F.map_keys("evidence")).alias("n_evidence"))


# ---------------------------------------------------------------- profile queries

def q_parse_tasks(spark, sf_dir):
    p = profile_inputs(spark, sf_dir)
    return ev.with_app_id(p["tasks"], p["apps"]).drop("log_id")


def q_parse_stages(spark, sf_dir):
    p = profile_inputs(spark, sf_dir)
    return ev.with_app_id(p["stages"], p["apps"]).drop("log_id")


def q_parse_apps(spark, sf_dir):
    return profile_inputs(spark, sf_dir)["apps"].drop("log_id")


def q_rejected_lines(spark, sf_dir):
    r = ev.rejected_lines(profile_inputs(spark, sf_dir)["lines"])
    return r.select(F.substring_index("log_id", "log=", -1).alias("app_id"), "value")


def q_conf_rejects(spark, sf_dir):
    files = fx.profile_files(spark, sf_dir)
    r = cf.rejected_confs(cf.read_conf_texts(spark, files["confs"], by="dir"))
    return r.select(F.substring_index("app_id", "app=", -1).alias("app_id"), F.regexp_replace("json", r"\s+$", "").alias("json"))


def q_stage_metrics(spark, sf_dir):
    m = _metrics(spark, sf_dir)
    dbl = ["task_p50_ms", "task_p95_ms", "skew_ratio_p95_p50", "skew_ratio_max_p50", "gc_pct",
           "shuffle_read_mb", "shuffle_write_mb", "spill_mb"]
    return m.select(*[_r(c) if c in dbl else F.col(c) for c in m.columns if c != "log_id"])


def q_top_stages(spark, sf_dir):
    t = top_stages(_metrics(spark, sf_dir), 10)
    return t.select("app_id", F.col("stage_rank").cast("bigint").alias("stage_rank"), "stage_id",
                    "attempt", "stage_duration_ms", "num_tasks")


def q_conf_typed(spark, sf_dir):
    p = profile_inputs(spark, sf_dir)
    return cf.conf_typed(p["confs"])


def q_cluster_valid(spark, sf_dir):
    c = cf.cluster_check(fx.clusters(spark, sf_dir))
    return c.select("app_id", "nodes", "cores_per_node", "valid", "reason")


def q_detect_skew(spark, sf_dir):
    return _finding_rows(fd.detect_skew(_metrics(spark, sf_dir)))


def q_detect_shuffle_heavy(spark, sf_dir):
    return _finding_rows(fd.detect_shuffle_heavy(_metrics(spark, sf_dir)))


def q_detect_spill_gc(spark, sf_dir):
    return _finding_rows(fd.detect_spill_gc(_metrics(spark, sf_dir)))


def q_detect_partitioning(spark, sf_dir):
    return _finding_rows(fd.detect_partitioning(_settings(spark, sf_dir)))


def q_findings_all(spark, sf_dir):
    f = _findings(spark, sf_dir)
    return f.select("app_id", "detector_seq", "code_seq", "code", "severity", "stage_id", "attempt",
                    F.explode("evidence").alias("evidence_key", "evidence_value")) \
            .withColumn("evidence_value", F.round("evidence_value", R))


def _sql_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = ev.read_eventlog(spark, fx.sql_files(spark, sf_dir), rolled=True)
    return lines, ev.parse_apps(ev.parse_events(lines, (ev.APP_START,)))


def _evidence_rows(f: DataFrame) -> DataFrame:
    return f.select("app_id", "code", "severity", "stage_id", "attempt", F.map_from_entries(F.transform(
        F.map_entries("evidence"), lambda e: F.struct(e["key"], F.round(e["value"], R)))).alias("e"))


def q_parse_plans(spark, sf_dir):
    lines, apps = _sql_inputs(spark, sf_dir)
    nodes = ev.with_app_id(sq.plan_nodes(lines), apps)
    return nodes.select("app_id", "execution_id", "node_id", "parent_id", "name", F.size("metrics").alias("n_metrics"))


def q_detect_join_strategy(spark, sf_dir):
    lines, apps = _sql_inputs(spark, sf_dir)
    limits = cf.broadcast_limits(profile_inputs(spark, sf_dir)["confs"])
    e = _evidence_rows(pf.join_findings(sq.node_facts(lines), apps, limits))
    keys = ["execution_id", "node_id", "small_bytes", "other_bytes", "broadcast_bytes", "output_rows"]
    return e.select("app_id", "code", "severity", "stage_id", "attempt", *[F.col("e")[k].alias(k) for k in keys])


def q_detect_file_layout(spark, sf_dir):
    lines, apps = _sql_inputs(spark, sf_dir)
    e = _evidence_rows(pf.file_findings(sq.node_facts(lines), apps))
    keys = ["execution_id", "node_id", "files", "mean_mb", "num_tasks"]
    return e.select("app_id", "code", "severity", "stage_id", "attempt", *[F.col("e")[k].alias(k) for k in keys])


def _recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = profile_inputs(spark, sf_dir)
    m, apps = profile_stages(p["events"])
    f = fd.findings_all(m, cf.app_settings(p["confs"], p["clusters"]), apps)
    return adv.recommend(f, p["confs"])


def q_recommendations(spark, sf_dir):
    r = _recs(spark, sf_dir)
    return r.select("app_id", F.col("rec_seq").cast("bigint").alias("rec_seq"), "code", "severity",
                    "stage_id", F.size("actions").alias("n_actions"), "n_adjusted")


def q_recommendations_json(spark, sf_dir):
    r = adv.recommendations_json(_recs(spark, sf_dir))
    return r.select("app_id", F.col("rec_seq").cast("bigint").alias("rec_seq"), "json")


def q_report_lines(spark, sf_dir):
    p = profile_inputs(spark, sf_dir)
    m, apps = profile_stages(p["events"])
    f = fd.findings_all(m, cf.app_settings(p["confs"], p["clusters"]), apps)
    lines = rp.report_lines(apps, m, f, adv.recommend(f, p["confs"]))
    from_line = (F.col("section") == rp.HEADER) & (F.col("line_no") == 1)  # the log without its parent's path
    line = F.when(from_line, F.concat(F.lit("from "), F.substring_index("line", "log=", -1))).otherwise(F.col("line"))
    return lines.withColumn("line", line).withColumn("item", F.array_join("item", "/")).drop("log_id")


def _runs(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """The fixture logs as two logs of each application, one with its even and one with its odd stages."""
    p = profile_inputs(spark, sf_dir)
    runs = F.when(F.col("stage_id").isNull(), F.array(F.lit(0), F.lit(1)).cast("array<bigint>")).otherwise(
        F.array(F.expr("pmod(stage_id, 2)")))
    rows = ev.stage_rows(p["events"]).withColumn("run", F.explode(runs))
    rows = rows.withColumn("log_id", F.concat_ws("#", "log_id", "run")).drop("run")
    return p, *profile_from_rows(rows)


def _run() -> F.Column:
    return F.substring_index("log_id", "#", -1).cast("bigint").alias("run")


def q_top_stages_by_log(spark, sf_dir):
    _, m, _ = _runs(spark, sf_dir)
    return top_stages(m, 10).select("app_id", _run(), F.col("stage_rank").cast("bigint").alias("stage_rank"), "stage_id",
                                    "attempt")


def q_recommendations_by_log(spark, sf_dir):
    p, m, apps = _runs(spark, sf_dir)
    f = fd.findings_all(m, cf.app_settings(p["confs"], p["clusters"]), apps)
    return adv.recommend(f, p["confs"]).select("app_id", _run(), F.col("rec_seq").cast("bigint").alias("rec_seq"), "code",
                                               "severity", "stage_id")


def q_cost_estimate(spark, sf_dir):
    c = co.estimate_cost(fx.cost_inputs(spark, sf_dir))
    dbl = ["node_hours", "rate_per_node_hour", "estimated_cost", "dbus", "rate_per_dbu_hour",
           "estimated_cost_dbu"]
    return c.select(*[_r(x) if x in dbl else F.col(x) for x in c.columns])


def q_cost_compare(spark, sf_dir):
    c = co.compare_cost(co.estimate_cost(fx.cost_inputs(spark, sf_dir)))
    return c.select("app_id", *[_r(x) for x in c.columns if x != "app_id"])


# ---------------------------------------------------------------- retrieval

def golden_versions(golden: DataFrame, versions: dict[str, int]) -> DataFrame:
    """``(version, qid, expected_doc_id)``: the golden set under each version."""
    v = F.explode(F.array(*[F.lit(x) for x in versions])).alias("version")
    return golden.select(v, "qid", "expected_doc_id")


def dense_queries(golden: DataFrame, versions: dict[str, int]) -> DataFrame:
    q = em.embed_dense(golden, versions, fx.DENSE_WIDTH, id_col="qid", vec_col="query_vec")
    return q.select("version", F.col("doc_id").alias("qid"), F.col("embedding").alias("query_vec"))


def text_queries(golden: DataFrame, versions: dict[str, int]) -> DataFrame:
    q = em.embed_text(golden, versions, id_col="qid", text_col="query")
    return q.withColumnRenamed("doc_id", "qid")


def _dense_hits(spark, sf_dir, k=5):
    vs = fx.DENSE_VERSIONS
    docs = em.embed_dense(fx.dense_docs(spark, sf_dir), vs, fx.DENSE_WIDTH)
    golden = fx.dense_golden(spark, sf_dir)
    return se.topk(docs, dense_queries(golden, vs), k, dims=vs), golden_versions(golden, vs)


def _text_hits(spark, sf_dir, k=5):
    vs = fx.TEXT_VERSIONS
    docs = em.embed_text(fx.text_docs(spark, sf_dir), vs)
    golden = fx.text_golden(spark, sf_dir)
    return se.topk(docs, text_queries(golden, vs), k, dims=vs), golden_versions(golden, vs)


def _hit_rows(h: DataFrame) -> DataFrame:
    return h.select("version", "qid", F.col("rank").cast("bigint").alias("rank"), "doc_id", _r("score"))


def _eval_rows(e: DataFrame) -> DataFrame:
    return e.select("version", "n_queries", _r("top1_accuracy"), _r("mrr"))


def q_build_dense(spark, sf_dir):
    v = em.embed_dense(fx.dense_docs(spark, sf_dir), fx.DENSE_VERSIONS, fx.DENSE_WIDTH)
    x = em.exploded(em.normalized_dense(v))
    return x.select("version", "doc_id", F.col("pos").cast("int").alias("pos"), _r("weight"))


def q_topk_dense(spark, sf_dir):
    return _hit_rows(_dense_hits(spark, sf_dir)[0])


def q_evaluate_version(spark, sf_dir):
    h, g = _dense_hits(spark, sf_dir)
    return _eval_rows(evl.evaluate(h, g))


def q_build_text(spark, sf_dir):
    v = em.embed_text(em.doc_text(_docs(spark, sf_dir)), fx.TEXT_VERSIONS)
    x = em.exploded(v)
    return x.select("version", "doc_id", F.col("pos").cast("int").alias("pos"), "weight")


def q_artifact_roundtrip(spark, sf_dir):
    """Title and body are embedded and written as a build, read back by version and searched with
    the stored golden set."""
    vs_ = fx.TEXT_VERSIONS
    reg = Registry(spark, scratch_path(spark, f"registry-{uuid.uuid4().hex}"))
    reg.write_vectors(em.embed_text(em.doc_text(_docs(spark, sf_dir)), vs_), 100)
    reg.replace_golden(fx.text_golden(spark, sf_dir))
    stored = reduce(DataFrame.unionByName, [reg.read_vectors(v) for v in vs_])
    return _hit_rows(se.topk(stored, text_queries(reg.golden(), vs_), 5, dims=vs_, stored=True))


def q_topk_text(spark, sf_dir):
    return _hit_rows(_text_hits(spark, sf_dir)[0])


def q_evaluate_text(spark, sf_dir):
    h, g = _text_hits(spark, sf_dir)
    return _eval_rows(evl.evaluate(h, g))


def version_pairs(spark: SparkSession, versions) -> DataFrame:
    """Every ordered (baseline, candidate) pair of the given versions."""
    rows = [(b, c) for b in versions for c in versions]
    return spark.createDataFrame(rows, "baseline_version string, candidate_version string")


def q_shadow_compare(spark, sf_dir):
    h, g = _dense_hits(spark, sf_dir)
    ev_ = evl.evaluate(h, g)
    sc = evl.shadow_compare(ev_, version_pairs(spark, list(fx.DENSE_VERSIONS)))
    return sc.select("baseline_version", "candidate_version", _r("baseline_top1"), _r("candidate_top1"),
                     _r("baseline_mrr"), _r("candidate_mrr"), "pass")


# ---------------------------------------------------------------- lifecycle

def _docs(spark, sf_dir) -> DataFrame:
    d = fx.table(spark, sf_dir, "documents")
    return d.select("doc_id", F.col("source").alias("title"), F.col("text").alias("body"),
                    F.lit(0).cast("bigint").alias("updated_at"))


def _upsert_batch(spark, sf_dir) -> DataFrame:
    d = fx.table(spark, sf_dir, "documents")
    rev = d.where(F.col("doc_id") % 7 == 0).select(
        "doc_id", F.col("source").alias("title"), F.concat(F.lit("rev2 "), "text").alias("body"))
    new = d.where(F.col("doc_id") % 50 == 0).select(
        (F.col("doc_id") + 1000000).alias("doc_id"), F.col("source").alias("title"), F.col("text").alias("body"))
    return rev.unionByName(new)


def q_docs_scan(spark, sf_dir):
    return vs.scan_docs(_docs(spark, sf_dir))


def q_docs_upsert(spark, sf_dir):
    return vs.upsert_docs(_docs(spark, sf_dir), _upsert_batch(spark, sf_dir), now=1)


def q_builds_latest(spark, sf_dir):
    """Build all text versions at t=100, then rebuild v1 on the upserted documents at t=200. The vectors
    of both builds are written, and the log counts what was written."""
    vs_ = fx.TEXT_VERSIONS
    reg = Registry(spark, scratch_path(spark, f"registry-{uuid.uuid4().hex}"))
    reg.write_vectors(em.embed_text(fx.text_docs(spark, sf_dir), vs_), 100)
    docs2 = vs.upsert_docs(_docs(spark, sf_dir), _upsert_batch(spark, sf_dir), now=1)
    reg.write_vectors(em.embed_text(docs2.select("doc_id", F.col("body").alias("text")), {"v1": vs_["v1"]}), 200)
    return vs.builds_latest(reg.read("builds"))


def q_eval_latest(spark, sf_dir):
    """Evaluate the dense versions at t=100 (k=5), then v2 again at t=200 with k=10."""
    h5, g = _dense_hits(spark, sf_dir, 5)
    vs_ = {"v2": fx.DENSE_VERSIONS["v2"]}
    docs = em.embed_dense(fx.dense_docs(spark, sf_dir), vs_, fx.DENSE_WIDTH)
    golden = fx.dense_golden(spark, sf_dir)
    h10 = se.topk(docs, dense_queries(golden, vs_), 10, dims=vs_)
    log = evl.evaluate(h5, g, 100).unionByName(evl.evaluate(h10, golden_versions(golden, vs_), 200))
    e = vs.evals_latest(log)
    return e.select("version", "evaluated_at", "n_queries", _r("top1_accuracy"), _r("mrr"))


def _lifecycle(spark, sf_dir) -> dict:
    """The steps of the lifecycle queries; versions are built and evaluated once for all of them."""
    def evaluated() -> DataFrame:
        h, g = _dense_hits(spark, sf_dir)
        return evl.evaluate(h, g)

    def built() -> DataFrame:
        return em.build_rows(em.embed_dense(fx.dense_docs(spark, sf_dir), fx.DENSE_VERSIONS, fx.DENSE_WIDTH), 100)

    evals = fx.made_once(spark, sf_dir, ("embeddings",), "dense-evaluation", evaluated)
    return lc.run_steps(evals, fx.made_once(spark, sf_dir, ("embeddings",), "dense-builds", built))


def q_promote_gate(spark, sf_dir):
    d = _lifecycle(spark, sf_dir)["decisions"]
    return d.select("step", "version", "previous", "gated", "shadow_pass", "promoted", "reason",
                    "is_built", "active")


def q_rollback(spark, sf_dir):
    return _lifecycle(spark, sf_dir)["rollbacks"].select("step", "rolled_back", "from_version", "to_version")


def q_shadow_log(spark, sf_dir):
    s = _lifecycle(spark, sf_dir)["shadow_log"]
    return s.select("step", "baseline_version", "candidate_version", "evaluated_at", _r("baseline_top1"),
                    _r("candidate_top1"), _r("baseline_mrr"), _r("candidate_mrr"), "pass")


def q_active_version(spark, sf_dir):
    return _lifecycle(spark, sf_dir)["active"]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_tasks": q_parse_tasks,
    "parse_stages": q_parse_stages,
    "parse_apps": q_parse_apps,
    "rejected_lines": q_rejected_lines,
    "conf_rejects": q_conf_rejects,
    "stage_metrics": q_stage_metrics,
    "top_stages": q_top_stages,
    "conf_typed": q_conf_typed,
    "cluster_valid": q_cluster_valid,
    "detect_skew": q_detect_skew,
    "detect_shuffle_heavy": q_detect_shuffle_heavy,
    "detect_spill_gc": q_detect_spill_gc,
    "detect_partitioning": q_detect_partitioning,
    "parse_plans": q_parse_plans,
    "detect_join_strategy": q_detect_join_strategy,
    "detect_file_layout": q_detect_file_layout,
    "findings_all": q_findings_all,
    "recommendations": q_recommendations,
    "recommendations_json": q_recommendations_json,
    "report_lines": q_report_lines,
    "top_stages_by_log": q_top_stages_by_log,
    "recommendations_by_log": q_recommendations_by_log,
    "cost_estimate": q_cost_estimate,
    "cost_compare": q_cost_compare,
    "build_dense": q_build_dense,
    "topk_dense": q_topk_dense,
    "evaluate_version": q_evaluate_version,
    "build_text": q_build_text,
    "artifact_roundtrip": q_artifact_roundtrip,
    "topk_text": q_topk_text,
    "evaluate_text": q_evaluate_text,
    "shadow_compare": q_shadow_compare,
    "docs_scan": q_docs_scan,
    "docs_upsert": q_docs_upsert,
    "builds_latest": q_builds_latest,
    "eval_latest": q_eval_latest,
    "promote_gate": q_promote_gate,
    "rollback": q_rollback,
    "shadow_log": q_shadow_log,
    "active_version": q_active_version,
}

"""DuckDB oracle SQL for every checked query (see ``perfkit.catalog``).

The oracles compute straight from the driver's tables with the FIXTURES.md
formulas; they never read the JSON lines, so they check the event-log round trip
as well as the operators. Column names and types match the Spark outputs.
"""

from __future__ import annotations

from perfkit.operators.advice import RULES

# ------------------------------------------------------------------ fixture CTEs

F_TASKS = """
f_base AS (
  SELECT *, CAST(floor(l_extendedprice) AS BIGINT) AS base FROM lineitem
),
f_tasks AS (
  SELECT 'app-' || CAST(l_suppkey % 25 AS VARCHAR) AS app_id,
         l_suppkey AS stage_id,
         CAST(l_linenumber % 2 AS BIGINT) AS attempt,
         l_orderkey * 10 + l_linenumber AS task_id,
         base AS run,
         epoch_ms(l_shipdate) AS launch,
         CASE WHEN l_returnflag = 'R' AND l_quantity < 5 THEN NULL
              ELSE epoch_ms(l_shipdate) + base * (CASE WHEN l_suppkey % 5 = 0 AND l_quantity >= 49 THEN 20
                                                       WHEN l_suppkey % 5 = 1 AND l_quantity >= 46 THEN 5
                                                       ELSE 1 END) END AS finish,
         CAST(floor(base * l_tax) AS BIGINT) * (CASE l_suppkey % 7 WHEN 0 THEN 7 WHEN 1 THEN 4 ELSE 1 END) AS gc,
         base * (CASE l_suppkey % 4 WHEN 0 THEN 60 WHEN 1 THEN 300 ELSE 6 END) AS remote,
         base * (CASE l_suppkey % 4 WHEN 0 THEN 40 WHEN 1 THEN 100 ELSE 4 END) AS local,
         base * (CASE l_suppkey % 4 WHEN 0 THEN 50 WHEN 1 THEN 100 ELSE 5 END) AS write,
         base * (CASE l_suppkey % 6 WHEN 0 THEN 40 WHEN 1 THEN 200 ELSE 1 END) AS spill_mem,
         base * (CASE l_suppkey % 6 WHEN 0 THEN 10 WHEN 1 THEN 50 ELSE 0 END) AS spill_disk
  FROM f_base
),
tasks AS (
  SELECT app_id, stage_id, attempt, task_id,
         greatest(0, coalesce(finish - launch, run)) AS duration_ms,
         gc AS gc_time_ms, remote + local AS shuffle_read_bytes, write AS shuffle_write_bytes,
         spill_mem AS spill_mem_bytes, spill_disk AS spill_disk_bytes
  FROM f_tasks
),
stages AS (
  SELECT app_id, stage_id, attempt, 'stage ' || CAST(stage_id AS VARCHAR) AS name,
         CAST(CASE WHEN stage_id % 10 = 6 THEN 5 ELSE count(*) END AS BIGINT) AS num_tasks,
         CASE WHEN stage_id % 9 = 4 THEN NULL ELSE min(launch) END AS submission_time_ms,
         max(coalesce(finish, launch + run)) AS completion_time_ms
  FROM f_tasks GROUP BY app_id, stage_id, attempt
  UNION ALL
  SELECT 'app-' || CAST(s_suppkey % 25 AS VARCHAR), s_suppkey + 1000000, CAST(0 AS BIGINT),
         'stage ' || CAST(s_suppkey + 1000000 AS VARCHAR), CAST(20 AS BIGINT),
         CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
  FROM supplier WHERE s_suppkey % 5 = 0
),
task_agg AS (
  SELECT app_id, stage_id, attempt,
         quantile_cont(duration_ms, 0.5) AS p50, quantile_cont(duration_ms, 0.95) AS p95,
         max(duration_ms) AS mx, CAST(sum(gc_time_ms) AS BIGINT) AS gc,
         CAST(sum(duration_ms) AS BIGINT) AS dur,
         CAST(sum(shuffle_read_bytes) AS BIGINT) AS rd, CAST(sum(shuffle_write_bytes) AS BIGINT) AS wr,
         CAST(sum(spill_mem_bytes) + sum(spill_disk_bytes) AS BIGINT) AS sp
  FROM tasks GROUP BY app_id, stage_id, attempt
),
metrics AS (
  SELECT s.app_id, s.stage_id, s.attempt, s.name, s.num_tasks,
         CASE WHEN submission_time_ms IS NOT NULL AND completion_time_ms IS NOT NULL
              THEN greatest(0, completion_time_ms - submission_time_ms) ELSE coalesce(mx, 0) END
           AS stage_duration_ms,
         coalesce(p50, 0.0) AS task_p50_ms, coalesce(p95, 0.0) AS task_p95_ms,
         coalesce(mx, 0) AS task_max_ms,
         CASE WHEN coalesce(p50, 0) > 0 THEN p95 / p50 ELSE 0.0 END AS skew_ratio_p95_p50,
         CASE WHEN coalesce(p50, 0) > 0 THEN mx / p50 ELSE 0.0 END AS skew_ratio_max_p50,
         CAST(coalesce(gc, 0) AS DOUBLE)
           / CAST(CASE WHEN coalesce(dur, 0) = 0 THEN 1 ELSE dur END AS DOUBLE) AS gc_pct,
         coalesce(rd, 0) / 1048576.0 AS shuffle_read_mb,
         coalesce(wr, 0) / 1048576.0 AS shuffle_write_mb,
         coalesce(sp, 0) / 1048576.0 AS spill_mb
  FROM stages s LEFT JOIN task_agg t USING (app_id, stage_id, attempt)
)"""

SETTINGS = """
settings AS (
  SELECT 'app-' || CAST(n_nationkey AS VARCHAR) AS app_id,
         CAST(CASE n_nationkey % 4 WHEN 1 THEN 2000 WHEN 2 THEN 8 ELSE 200 END AS BIGINT) AS shuffle_partitions,
         CAST(CASE n_nationkey % 3 WHEN 1 THEN 4 WHEN 2 THEN 64 ELSE 0 END AS BIGINT) AS default_parallelism,
         (n_nationkey % 2 = 0) AS aqe_enabled,
         (n_nationkey % 5 = 0) AS skew_join_enabled,
         CASE WHEN n_nationkey = 24 THEN 0 ELSE 1 + n_nationkey % 10 END AS nodes
  FROM nation
),
valid_settings AS (
  SELECT *, CAST(nodes AS BIGINT) * 4 AS cores_total FROM settings WHERE nodes >= 1
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _detector(sel_where: list[tuple[int, int, str, str, str, list[tuple[str, str]]]], rows: str) -> str:
    """Union of detector branches over ``metrics``/``valid_settings``.

    Each branch: (detector_seq, code_seq, code, severity_sql, where_sql, evidence[(key, sql)]).
    ``rows`` = 'count' gives one row per finding with ``n_evidence``; 'evidence' one row per key.
    """
    parts = []
    for dseq, cseq, code, sev, where, evid in sel_where:
        src = "valid_settings" if dseq == 4 else "metrics"
        stage = "CAST(NULL AS BIGINT)" if dseq == 4 else "stage_id"
        attempt = "CAST(NULL AS BIGINT)" if dseq == 4 else "attempt"
        head = (f"SELECT app_id, {dseq} AS detector_seq, {cseq} AS code_seq, '{code}' AS code, "
                f"{sev} AS severity, {stage} AS stage_id, {attempt} AS attempt")
        if rows == "count":
            parts.append(f"{head}, {len(evid)} AS n_evidence FROM {src} WHERE {where}")
        else:
            for k, e in evid:
                parts.append(f"{head}, '{k}' AS evidence_key, round(CAST({e} AS DOUBLE), 6) AS evidence_value "
                             f"FROM {src} WHERE {where}")
    return "\nUNION ALL\n".join(parts)


SKEW = [(1, 1, "SKEW_DETECTED",
         "CASE WHEN skew_ratio_max_p50 >= 16.0 THEN 'ERROR' ELSE 'WARN' END",
         "num_tasks >= 10 AND (skew_ratio_p95_p50 >= 3.0 OR skew_ratio_max_p50 >= 8.0)",
         [("p95_p50", "skew_ratio_p95_p50"), ("max_p50", "skew_ratio_max_p50"), ("p50_ms", "task_p50_ms"),
          ("p95_ms", "task_p95_ms"), ("max_ms", "task_max_ms")])]
SHUFFLE = [(2, 1, "SHUFFLE_HEAVY",
            "CASE WHEN shuffle_read_mb + shuffle_write_mb >= 5120.0 THEN 'ERROR' ELSE 'WARN' END",
            "shuffle_read_mb + shuffle_write_mb >= 1024.0",
            [("shuffle_read_mb", "shuffle_read_mb"), ("shuffle_write_mb", "shuffle_write_mb"),
             ("spill_mb", "spill_mb")])]
SPILL_GC = [(3, 1, "SPILL_DETECTED", "CASE WHEN spill_mb < 2560.0 THEN 'WARN' ELSE 'ERROR' END",
             "spill_mb >= 512.0", [("spill_mb", "spill_mb")]),
            (3, 2, "GC_PRESSURE", "CASE WHEN gc_pct < 0.2 THEN 'WARN' ELSE 'ERROR' END",
             "gc_pct >= 0.1", [("gc_pct", "gc_pct")])]
_LOW = "greatest(8, cores_total // 4)"
PARTITIONING = [(4, 1, "OVER_PARTITIONED", "'WARN'", "shuffle_partitions >= cores_total * 20",
                 [("shuffle_partitions", "shuffle_partitions"), ("cores_total", "cores_total")]),
                (4, 2, "UNDER_PARTITIONED", "'WARN'", f"shuffle_partitions <= {_LOW}",
                 [("shuffle_partitions", "shuffle_partitions"), ("cores_total", "cores_total")]),
                (4, 3, "LOW_DEFAULT_PARALLELISM", "'INFO'",
                 f"default_parallelism <> 0 AND default_parallelism <= {_LOW}",
                 [("default_parallelism", "default_parallelism"), ("cores_total", "cores_total")])]

_METRIC_DOUBLES = ["task_p50_ms", "task_p95_ms", "skew_ratio_p95_p50", "skew_ratio_max_p50", "gc_pct",
                   "shuffle_read_mb", "shuffle_write_mb", "spill_mb"]
_METRIC_COLS = ["app_id", "stage_id", "attempt", "name", "num_tasks", "stage_duration_ms",
                "task_p50_ms", "task_p95_ms", "task_max_ms", "skew_ratio_p95_p50",
                "skew_ratio_max_p50", "gc_pct", "shuffle_read_mb", "shuffle_write_mb", "spill_mb"]


def _profile() -> dict[str, str]:
    w = _with(F_TASKS)
    ws = _with(F_TASKS, SETTINGS)
    metric_sel = ", ".join(f"round({c}, 6) AS {c}" if c in _METRIC_DOUBLES else c for c in _METRIC_COLS)
    return {
        "parse_tasks": w + "SELECT * FROM tasks",
        "parse_stages": w + "SELECT * FROM stages",
        "parse_apps": (
            "SELECT DISTINCT 'app-' || CAST(s_suppkey % 25 AS VARCHAR) AS app_id, "
            "'job-' || CAST(s_suppkey % 25 AS VARCHAR) AS app_name FROM supplier"),
        "rejected_lines": (
            "SELECT DISTINCT 'app-' || CAST(s_suppkey % 25 AS VARCHAR) AS app_id, CASE s_suppkey % 5"
            """ WHEN 0 THEN '{"Event":"SparkListenerTaskEnd","Stage ID":' WHEN 1 THEN '{"Event":"SparkListenerTa'"""
            """ ELSE '{"Event":"SparkListenerTaskEnd","Stage ID":"seven"}' END AS value"""
            " FROM supplier WHERE s_suppkey % 5 <= 2"),
        "conf_rejects": (
            "SELECT 'cut-' || CAST(n_nationkey AS VARCHAR) AS app_id,"
            """ '{"spark.sql.shuffle.partitions": "20' AS json FROM nation WHERE n_nationkey % 6 = 0"""),
        "stage_metrics": w + f"SELECT {metric_sel} FROM metrics",
        "top_stages": w + (
            "SELECT app_id, stage_rank, stage_id, attempt, stage_duration_ms, num_tasks FROM ("
            " SELECT *, CAST(row_number() OVER (PARTITION BY app_id ORDER BY stage_duration_ms DESC,"
            " stage_id, attempt) AS BIGINT) AS stage_rank FROM metrics) WHERE stage_rank <= 10"),
        "conf_typed": ws + (
            "SELECT app_id, CAST(CASE WHEN shuffle_partitions = 2000 THEN 2000 WHEN shuffle_partitions = 8"
            " THEN 8 ELSE 200 END AS BIGINT) AS shuffle_partitions, default_parallelism, aqe_enabled,"
            " skew_join_enabled FROM settings"),
        "cluster_valid": (
            "SELECT 'app-' || CAST(n_nationkey AS VARCHAR) AS app_id,"
            " CAST(CASE WHEN n_nationkey = 24 THEN 0 ELSE 1 + n_nationkey % 10 END AS INTEGER) AS nodes,"
            " 4 AS cores_per_node, (n_nationkey <> 24) AS valid,"
            " CASE WHEN n_nationkey = 24 THEN 'nodes must be >= 1' END AS reason FROM nation"),
        "detect_skew": w + _detector(SKEW, "count"),
        "detect_shuffle_heavy": w + _detector(SHUFFLE, "count"),
        "detect_spill_gc": w + _detector(SPILL_GC, "count"),
        "detect_partitioning": ws + _detector(PARTITIONING, "count"),
        "findings_all": ws + _detector(SKEW + SHUFFLE + SPILL_GC + PARTITIONING, "evidence"),
    }


def _fixed(x: str, digits: int) -> str:
    """``x`` (not negative) as text, rounded half up on millionths."""
    step, one = 10 ** (6 - digits), 10 ** digits
    units = f"((CAST(floor(CAST({x} AS DOUBLE) * CAST(1e6 AS DOUBLE) + 0.5::DOUBLE) AS BIGINT) + {step // 2}) // {step})"
    if not digits:
        return f"CAST({units} AS VARCHAR)"
    return f"(CAST({units} // {one} AS VARCHAR) || '.' || lpad(CAST({units} % {one} AS VARCHAR), {digits}, '0'))"


# What each finding says, in SQL over ``metrics`` or ``valid_settings``.
_MESSAGES = {
    "SKEW_DETECTED": f"'stage ' || stage_id || ': slow tail, 95th percentile at ' || {_fixed('skew_ratio_p95_p50', 2)}"
                     f" || ' and slowest task at ' || {_fixed('skew_ratio_max_p50', 2)} || ' times the median'",
    "SHUFFLE_HEAVY": f"'stage ' || stage_id || ': ' || {_fixed('shuffle_read_mb + shuffle_write_mb', 0)}"
                     " || ' MB read and written by shuffles'",
    "SPILL_DETECTED": f"'stage ' || stage_id || ': ' || {_fixed('spill_mb', 0)} || ' MB did not fit in memory'",
    "GC_PRESSURE": f"'stage ' || stage_id || ': collector active for ' || {_fixed('gc_pct * 100', 1)}"
                   " || '% of task time'",
    "OVER_PARTITIONED": "shuffle_partitions || ' shuffle partitions planned, cluster runs ' || cores_total"
                        " || ' tasks at once'",
    "UNDER_PARTITIONED": "shuffle_partitions || ' shuffle partitions planned, too few to fill ' || cores_total"
                         " || ' cores'",
    "LOW_DEFAULT_PARALLELISM": "'RDD stages get ' || default_parallelism || ' tasks by default, cluster has '"
                               " || cores_total || ' cores'",
}


def _quoted(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def _texts() -> str:
    """CTEs ``findings`` (with message and evidence as JSON) and ``recs`` (with the rule's texts)."""
    parts = []
    for dseq, cseq, code, sev, where, evid in SKEW + SHUFFLE + SPILL_GC + PARTITIONING:
        app = dseq == 4
        stage, attempt = ("CAST(NULL AS BIGINT)",) * 2 if app else ("stage_id", "attempt")
        pairs = " || ',' || ".join(f"""'"{k}":' || regexp_replace({_fixed(e, 6)}, '0{{1,5}}$', '')""" for k, e in evid)
        parts.append(f"SELECT app_id, {dseq} AS detector_seq, {cseq} AS code_seq, '{code}' AS code, {sev} AS severity, "
                     f"{stage} AS stage_id, {attempt} AS attempt, {_MESSAGES[code]} AS message, "
                     f"'{{' || {pairs} || '}}' AS evidence FROM {'valid_settings' if app else 'metrics'} WHERE {where}")
    rules = ", ".join(
        f"({_quoted(code)}, {_quoted(title)}, {_quoted(why)}, [{', '.join(map(_quoted, actions))}], "
        f"{'NULL' if i is None else i + 1}, {_quoted(i_alt)}, {'NULL' if j is None else j + 1}, {_quoted(j_alt)})"
        for code, title, why, actions, i, i_alt, j, j_alt in RULES)
    union = "\nUNION ALL\n".join(parts)
    return f"""findings AS ({union}),
rules AS (SELECT * FROM (VALUES {rules}) t(code, title, rationale, listed, aqe_at, aqe_alt, skew_at, skew_alt)),
recs AS (
  SELECT f.*, title, rationale,
         list_transform(range(1, len(listed) + 1), lambda i:
           CASE WHEN coalesce(s.aqe_enabled, false) AND i = aqe_at THEN aqe_alt
                WHEN coalesce(s.skew_join_enabled, false) AND i = skew_at THEN skew_alt ELSE listed[i] END) AS actions,
         CAST(row_number() OVER (PARTITION BY f.app_id ORDER BY
              CASE severity WHEN 'ERROR' THEN 0 WHEN 'WARN' THEN 1 WHEN 'INFO' THEN 2 ELSE 9 END,
              f.stage_id NULLS LAST, detector_seq, f.attempt, code_seq) AS BIGINT) AS rec_seq
  FROM findings f JOIN rules r ON r.code = f.code LEFT JOIN settings s ON s.app_id = f.app_id
)"""


_JSON = """
SELECT app_id, rec_seq,
       '{"severity":' || CAST(to_json(severity) AS VARCHAR) || ',"title":' || CAST(to_json(title) AS VARCHAR)
       || ',"stage_id":' || coalesce(CAST(stage_id AS VARCHAR), 'null')
       || ',"rationale":' || CAST(to_json(rationale) AS VARCHAR) || ',"actions":' || CAST(to_json(actions) AS VARCHAR)
       || ',"evidence":' || evidence || '}' AS json
FROM recs"""

_REPORT = f""",
apps AS (SELECT DISTINCT s_suppkey % 25 AS n, 'app-' || CAST(s_suppkey % 25 AS VARCHAR) AS app_id FROM supplier),
top AS (
  SELECT *, row_number() OVER (PARTITION BY app_id ORDER BY stage_duration_ms DESC, stage_id, attempt) AS place
  FROM metrics),
lines AS (
  SELECT app_id, 1 AS section, '0' AS item, ['Profile of job-' || n || ' (' || app_id || ')', 'from ' || app_id] AS lines
  FROM apps
  UNION ALL
  SELECT app_id, 2, CAST(place AS VARCHAR), ['stage ' || stage_id || ' ran ' || stage_duration_ms || ' ms: ' || num_tasks
         || ' tasks, typical ' || {_fixed('task_p50_ms', 0)} || ' ms, p95 ' || {_fixed('task_p95_ms', 0)}
         || ' ms, slowest ' || task_max_ms || ' ms; shuffled ' || {_fixed('shuffle_read_mb + shuffle_write_mb', 0)}
         || ' MB, spilled ' || {_fixed('spill_mb', 0)} || ' MB, collector ' || {_fixed('gc_pct * 100', 1)} || '%']
  FROM top WHERE place <= 10
  UNION ALL
  SELECT app_id, 2, '0', ['the log has no completed stage'] FROM apps WHERE app_id NOT IN (SELECT app_id FROM metrics)
  UNION ALL
  SELECT app_id, 3, detector_seq || '/' || coalesce(stage_id, -1) || '/' || coalesce(attempt, -1) || '/' || code_seq,
         [severity || ' ' || code || ', ' || coalesce('stage ' || stage_id, 'whole application') || ': ' || message]
  FROM findings
  UNION ALL
  SELECT app_id, 3, '0', ['nothing stands out'] FROM apps WHERE app_id NOT IN (SELECT app_id FROM findings)
  UNION ALL
  SELECT app_id, 4, CAST(rec_seq AS VARCHAR),
         list_concat([title || ' (' || severity || ', ' || coalesce('stage ' || stage_id, 'whole application') || ')',
                      '   ' || rationale],
                     list_concat(list_transform(range(1, len(actions) + 1), lambda i: '   step ' || i || ' ' || actions[i]),
                                 ['   measured ' || evidence]))
  FROM recs
  UNION ALL
  SELECT app_id, 4, '0', ['nothing to change'] FROM apps WHERE app_id NOT IN (SELECT app_id FROM recs))
SELECT app_id, section, item, CAST(i - 1 AS INTEGER) AS line_no, lines[i] AS line
FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM lines)"""


COST_INPUTS = """
cost_in AS (
  SELECT 'app-' || CAST(n_nationkey AS VARCHAR) AS app_id, 'current' AS scenario,
         CAST(n_nationkey * 600 - 300 AS BIGINT) AS runtime_seconds,
         CAST(CASE WHEN n_nationkey = 24 THEN 0 ELSE 1 + n_nationkey % 10 END AS BIGINT) AS nodes,
         CAST(0.45 AS DOUBLE) AS rate,
         CAST(CASE WHEN n_nationkey % 3 <> 0 THEN 2 ELSE 0 END AS DOUBLE) AS dpn,
         CAST(0.15 AS DOUBLE) AS rdbu
  FROM nation
),
cost_all AS (
  SELECT * FROM cost_in
  UNION ALL
  SELECT app_id, 'optimized', CAST(trunc(runtime_seconds * 7 / 10) AS BIGINT),
         CAST(CASE WHEN nodes // 2 = 0 THEN 1 ELSE nodes // 2 END AS BIGINT), rate, dpn, rdbu
  FROM cost_in
),
cost AS (
  SELECT app_id, scenario, greatest(0, runtime_seconds) AS runtime_seconds,
         greatest(1, nodes) AS nodes,
         CAST(greatest(0, runtime_seconds) AS DOUBLE) / 3600.0 * greatest(1, nodes) AS node_hours,
         rate AS rate_per_node_hour,
         CAST(greatest(0, runtime_seconds) AS DOUBLE) / 3600.0 * greatest(1, nodes) * rate AS estimated_cost,
         CASE WHEN dpn <> 0 AND rdbu <> 0
              THEN CAST(greatest(0, runtime_seconds) AS DOUBLE) / 3600.0 * greatest(1, nodes) * dpn END AS dbus,
         CASE WHEN rdbu <> 0 THEN rdbu END AS rate_per_dbu_hour,
         CASE WHEN dpn <> 0 AND rdbu <> 0
              THEN CAST(greatest(0, runtime_seconds) AS DOUBLE) / 3600.0 * greatest(1, nodes) * dpn * rdbu
         END AS estimated_cost_dbu
  FROM cost_all
)"""

_RULE_ACTIONS = ("CASE code WHEN 'SKEW_DETECTED' THEN 4 WHEN 'SHUFFLE_HEAVY' THEN 4 WHEN 'SPILL_DETECTED' THEN 3 "
                 "WHEN 'GC_PRESSURE' THEN 3 WHEN 'OVER_PARTITIONED' THEN 3 WHEN 'UNDER_PARTITIONED' THEN 2 "
                 "WHEN 'LOW_DEFAULT_PARALLELISM' THEN 2 END")


def _extra() -> dict[str, str]:
    findings = _detector(SKEW + SHUFFLE + SPILL_GC + PARTITIONING, "count")
    recs = _with(F_TASKS, SETTINGS, f"findings AS ({findings})") + f"""
SELECT f.app_id,
       CAST(row_number() OVER (PARTITION BY f.app_id ORDER BY
            CASE severity WHEN 'ERROR' THEN 0 WHEN 'WARN' THEN 1 WHEN 'INFO' THEN 2 ELSE 9 END,
            f.stage_id NULLS LAST, detector_seq, f.attempt, code_seq) AS BIGINT) AS rec_seq,
       code, severity, f.stage_id, {_RULE_ACTIONS} AS n_actions,
       CASE WHEN code = 'SKEW_DETECTED'
            THEN CAST(coalesce(s.aqe_enabled, false) AS INTEGER) + CAST(coalesce(s.skew_join_enabled, false) AS INTEGER)
            ELSE 0 END AS n_adjusted
FROM findings f LEFT JOIN settings s ON s.app_id = f.app_id"""
    by_log = _with(F_TASKS, SETTINGS, f"findings AS ({findings})", """
runs AS (SELECT DISTINCT 'app-' || CAST(s_suppkey % 25 AS VARCHAR) AS app_id, unnest([0, 1]) AS run FROM supplier),
placed AS (
  SELECT f.*, CAST(coalesce(f.stage_id % 2, r.run) AS BIGINT) AS run
  FROM findings f LEFT JOIN runs r ON f.stage_id IS NULL AND f.app_id = r.app_id
)""") + """
SELECT app_id, run,
       CAST(row_number() OVER (PARTITION BY app_id, run ORDER BY
            CASE severity WHEN 'ERROR' THEN 0 WHEN 'WARN' THEN 1 WHEN 'INFO' THEN 2 ELSE 9 END,
            stage_id NULLS LAST, detector_seq, attempt, code_seq) AS BIGINT) AS rec_seq,
       code, severity, stage_id
FROM placed"""
    top_by_log = _with(F_TASKS) + """
SELECT app_id, stage_id % 2 AS run, stage_id, attempt,
       CAST(row_number() OVER (PARTITION BY app_id, stage_id % 2 ORDER BY stage_duration_ms DESC, stage_id, attempt)
            AS BIGINT) AS stage_rank
FROM metrics QUALIFY stage_rank <= 10"""
    cost_cols = ["node_hours", "rate_per_node_hour", "estimated_cost", "dbus", "rate_per_dbu_hour",
                 "estimated_cost_dbu"]
    cost_sel = ", ".join(["app_id", "scenario", "runtime_seconds", "nodes"]
                         + [f"round({c}, 6) AS {c}" for c in cost_cols])
    return {
        "recommendations": recs,
        "recommendations_json": _with(F_TASKS, SETTINGS, _texts()) + _JSON,
        "report_lines": _with(F_TASKS, SETTINGS, _texts()) + _REPORT,
        "top_stages_by_log": top_by_log,
        "recommendations_by_log": by_log,
        "cost_estimate": _with(COST_INPUTS) + f"SELECT {cost_sel} FROM cost",
        "cost_compare": _with(COST_INPUTS) + """
SELECT c.app_id, round(c.estimated_cost, 6) AS current_cost, round(o.estimated_cost, 6) AS optimized_cost,
       round(c.estimated_cost - o.estimated_cost, 6) AS savings,
       round(c.node_hours, 6) AS current_node_hours, round(o.node_hours, 6) AS optimized_node_hours,
       round(c.node_hours - o.node_hours, 6) AS node_hours_saved
FROM cost c JOIN cost o ON c.app_id = o.app_id AND c.scenario = 'current' AND o.scenario = 'optimized'""",
    }


DENSE = """
dvers AS (SELECT * FROM (VALUES ('v1', 64), ('v2', 8), ('v3', 32)) t(version, d)),
dgold AS (
  SELECT a.vec_id AS qid, a.vec_id AS expected_doc_id,
         CASE WHEN b.embedding IS NULL THEN list_transform(a.embedding, lambda x: CAST(x AS DOUBLE))
              ELSE list_transform(list_zip(a.embedding, b.embedding),
                                  lambda p: CAST(p[1] AS DOUBLE) + CAST(0.9 AS DOUBLE) * CAST(p[2] AS DOUBLE))
         END AS qv
  FROM embeddings a LEFT JOIN embeddings b ON b.vec_id = a.vec_id + 1
  WHERE a.vec_id % 100 = 0
),
dsign AS (
  SELECT version, i, CAST(j AS INTEGER) AS pos,
         CASE WHEN d = 64 THEN CASE WHEN i = j THEN 1.0 ELSE 0.0 END
              WHEN substr(md5(version || '::' || i || '::' || j), 1, 1) < '8' THEN 1.0 ELSE -1.0 END::DOUBLE AS s
  FROM dvers, range(1, 65) a(i), range(1, d + 1) b(j)
),
dvec AS (
  SELECT version, doc_id, pos, CAST(CAST(sum(x * s) AS FLOAT) AS DOUBLE) AS w
  FROM (SELECT vec_id AS doc_id, CAST(embedding[i] AS DOUBLE) AS x, i FROM embeddings, range(1, 65) r(i))
  JOIN dsign USING (i) GROUP BY ALL
),
qvec AS (
  SELECT version, qid, pos, sum(x * s) AS w
  FROM (SELECT qid, qv[i] AS x, i FROM dgold, range(1, 65) r(i)) JOIN dsign USING (i) GROUP BY ALL
),
dnorm AS (SELECT version, doc_id, sum(w * w) AS n FROM dvec GROUP BY ALL),
qnorm AS (SELECT version, qid, sum(w * w) AS n FROM qvec GROUP BY ALL),
ddot AS (
  SELECT q.version, q.qid, d.doc_id, sum(q.w * d.w) AS s
  FROM qvec q JOIN dvec d ON q.version = d.version AND q.pos = d.pos GROUP BY ALL
),
dscore AS (
  SELECT t.version, t.qid, t.doc_id,
         round(CASE WHEN qn.n * dn.n > 0 THEN t.s / sqrt(qn.n * dn.n) ELSE 0.0 END, 9) AS score
  FROM ddot t JOIN qnorm qn USING (version, qid) JOIN dnorm dn USING (version, doc_id)
),
dhits AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY version, qid ORDER BY score DESC, doc_id) AS rank
                 FROM dscore) WHERE rank <= 5
),
deval AS (
  SELECT g.version, count(*) AS n_queries,
         avg(CASE WHEN h.rank = 1 THEN 1.0 ELSE 0.0 END) AS top1_accuracy,
         avg(coalesce(1.0 / h.rank, 0.0)) AS mrr
  FROM (SELECT version, qid, expected_doc_id FROM dgold, dvers) g
  LEFT JOIN dhits h ON h.version = g.version AND h.qid = g.qid AND h.doc_id = g.expected_doc_id
  GROUP BY g.version
)"""

TEXT = """
tvers AS (SELECT * FROM (VALUES ('v1', 384), ('v2', 64), ('v3', 1024)) t(version, d)),
ttok AS (SELECT doc_id, string_split(trim(regexp_replace({text}, '\\s+', ' ', 'g')), ' ') AS toks FROM documents),
tgold AS (SELECT doc_id AS qid, doc_id AS expected_doc_id,
                 string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ') AS qt
          FROM documents WHERE doc_id % 100 = 0),
tdv AS (
  SELECT version, doc_id, CAST(CAST('0x' || substr(md5(version || '::' || t), 1, 8) AS BIGINT) % d AS INTEGER) AS b,
         count(*) AS c
  FROM (SELECT doc_id, unnest(toks) AS t FROM ttok), tvers GROUP BY ALL
),
tqv AS (
  SELECT version, qid, CAST(CAST('0x' || substr(md5(version || '::' || t), 1, 8) AS BIGINT) % d AS INTEGER) AS b,
         count(*) AS c
  FROM (SELECT qid, unnest(qt) AS t FROM tgold), tvers GROUP BY ALL
),
tdn AS (SELECT version, doc_id, sum(c * c) AS n FROM tdv GROUP BY ALL),
tqn AS (SELECT version, qid, sum(c * c) AS n FROM tqv GROUP BY ALL),
tdot AS (
  SELECT q.version, q.qid, d.doc_id, sum(q.c * d.c) AS s
  FROM tqv q JOIN tdv d ON q.version = d.version AND q.b = d.b GROUP BY ALL
),
tscore AS (
  SELECT t.version, t.qid, t.doc_id, round(t.s / sqrt(CAST(qn.n * dn.n AS DOUBLE)), 9) AS score
  FROM tdot t JOIN tqn qn USING (version, qid) JOIN tdn dn USING (version, doc_id)
),
thits AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY version, qid ORDER BY score DESC, doc_id) AS rank
                 FROM tscore) WHERE rank <= 5
),
teval AS (
  SELECT g.version, count(*) AS n_queries,
         avg(CASE WHEN h.rank = 1 THEN 1.0 ELSE 0.0 END) AS top1_accuracy,
         avg(coalesce(1.0 / h.rank, 0.0)) AS mrr
  FROM (SELECT version, qid, expected_doc_id FROM tgold, tvers) g
  LEFT JOIN thits h ON h.version = g.version AND h.qid = g.qid AND h.doc_id = g.expected_doc_id
  GROUP BY g.version
)"""


TITLED = TEXT.replace("{text}", "coalesce(source, '') || chr(10) || coalesce(text, '')")
TEXT = TEXT.replace("{text}", "text")


def _retrieval() -> dict[str, str]:
    hit = "SELECT version, qid, CAST(rank AS BIGINT) AS rank, doc_id, round(score, 6) AS score FROM {}"
    ev = ("SELECT version, n_queries, round(CAST(top1_accuracy AS DOUBLE), 6) AS top1_accuracy, "
          "round(CAST(mrr AS DOUBLE), 6) AS mrr FROM {}")
    gate = """
SELECT b.version AS baseline_version, c.version AS candidate_version,
       round(b.top1_accuracy, 6) AS baseline_top1, round(c.top1_accuracy, 6) AS candidate_top1,
       round(b.mrr, 6) AS baseline_mrr, round(c.mrr, 6) AS candidate_mrr,
       (c.top1_accuracy >= greatest(0.6, b.top1_accuracy - 0.02)
        AND c.mrr >= greatest(0.6, b.mrr - 0.02)) AS pass
FROM evd b, evd c"""
    return {
        "build_dense": _with(DENSE) + (
            "SELECT v.version, v.doc_id, CAST(v.pos - 1 AS INTEGER) AS pos, "
            "round(CASE WHEN n.n > 0 THEN v.w / sqrt(n.n) ELSE 0.0 END, 6) AS weight "
            "FROM dvec v JOIN dnorm n USING (version, doc_id)"),
        "topk_dense": _with(DENSE) + hit.format("dhits"),
        "evaluate_version": _with(DENSE) + ev.format("deval"),
        "artifact_roundtrip": _with(TITLED) + hit.format("thits"),
        "build_text": _with(TITLED) + "SELECT version, doc_id, b AS pos, CAST(c AS DOUBLE) AS weight FROM tdv",
        "topk_text": _with(TEXT) + hit.format("thits"),
        "evaluate_text": _with(TEXT) + ev.format("teval"),
        "shadow_compare": _with(DENSE, "evd AS (SELECT version, CAST(top1_accuracy AS DOUBLE) AS top1_accuracy, "
                                       "CAST(mrr AS DOUBLE) AS mrr FROM deval)") + gate,
    }


UPSERT = """
ubase AS (SELECT doc_id, source AS title, text AS body, CAST(0 AS BIGINT) AS updated_at, 0 AS src FROM documents),
ubatch AS (
  SELECT doc_id, source AS title, 'rev2 ' || text AS body, CAST(1 AS BIGINT) AS updated_at, 1 AS src
  FROM documents WHERE doc_id % 7 = 0
  UNION ALL
  SELECT doc_id + 1000000, source, text, CAST(1 AS BIGINT), 1 FROM documents WHERE doc_id % 50 = 0
),
udocs AS (
  SELECT doc_id, title, body, updated_at FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY updated_at DESC, src DESC) AS rn
    FROM (SELECT * FROM ubase UNION ALL SELECT * FROM ubatch)) WHERE rn = 1
)"""

SCENARIO = """
gev AS (SELECT version, CAST(top1_accuracy AS DOUBLE) AS t, CAST(mrr AS DOUBLE) AS m FROM deval),
gate AS (
  SELECT b.version AS bv, c.version AS cv, b.t AS bt, c.t AS ct, b.m AS bm, c.m AS cm,
         (c.t >= greatest(0.6, b.t - 0.02) AND c.m >= greatest(0.6, b.m - 0.02)) AS pass
  FROM gev b, gev c
),
st1 AS (SELECT 'v1' AS a0, 'v1' AS a1),
st2 AS (SELECT st1.*, g.pass AS p2, CASE WHEN g.pass THEN 'v2' ELSE a1 END AS a2
        FROM st1 JOIN gate g ON g.bv = st1.a1 AND g.cv = 'v2'),
st3 AS (SELECT st2.*, g.pass AS p3, CASE WHEN g.pass THEN 'v3' ELSE a2 END AS a3
        FROM st2 JOIN gate g ON g.bv = st2.a2 AND g.cv = 'v3'),
st4 AS (SELECT st3.*, 'v2' AS a4 FROM st3),
st AS (SELECT st4.*, g.pass AS p5, CASE WHEN g.pass THEN 'v3' ELSE a4 END AS a5
       FROM st4 JOIN gate g ON g.bv = st4.a4 AND g.cv = 'v3')"""


def _lifecycle() -> dict[str, str]:
    rs = "round({0}, 6) AS {1}"

    def shadow_row(step, base, cand):
        return (f"SELECT {step} AS step, g.bv AS baseline_version, g.cv AS candidate_version, "
                f"CAST({1000 + step} AS BIGINT) AS evaluated_at, "
                + ", ".join(rs.format(a, b) for a, b in [("g.bt", "baseline_top1"), ("g.ct", "candidate_top1"),
                                                       ("g.bm", "baseline_mrr"), ("g.cm", "candidate_mrr")])
                + f", g.pass AS pass FROM st JOIN gate g ON g.bv = st.{base} AND g.cv = '{cand}'")

    def gate_row(step, version, prev, passed, active):
        return (f"SELECT {step} AS step, '{version}' AS version, {prev} AS previous, true AS gated, "
                f"{passed} AS shadow_pass, {passed} AS promoted, "
                f"CASE WHEN NOT {passed} THEN 'shadow_eval_failed' END AS reason, true AS is_built, "
                f"{active} AS active FROM st")

    return {
        "docs_scan": "SELECT doc_id, source AS title, text AS body FROM documents",
        "docs_upsert": _with(UPSERT) + "SELECT * FROM udocs",
        "builds_latest": _with(UPSERT) + """
SELECT 'v1' AS version, CAST(200 AS BIGINT) AS built_at, count(*) AS doc_count FROM udocs WHERE body IS NOT NULL
UNION ALL
SELECT v.version, CAST(100 AS BIGINT), (SELECT count(*) FROM documents WHERE text IS NOT NULL)
FROM (VALUES ('v2'), ('v3')) v(version)""",
        "eval_latest": _with(DENSE, """
dhits10 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY version, qid ORDER BY score DESC, doc_id) AS rank
                 FROM dscore WHERE version = 'v2') WHERE rank <= 10
),
deval10 AS (
  SELECT g.version, count(*) AS n_queries,
         avg(CASE WHEN h.rank = 1 THEN 1.0 ELSE 0.0 END) AS top1_accuracy,
         avg(coalesce(1.0 / h.rank, 0.0)) AS mrr
  FROM (SELECT 'v2' AS version, qid, expected_doc_id FROM dgold) g
  LEFT JOIN dhits10 h ON h.version = g.version AND h.qid = g.qid AND h.doc_id = g.expected_doc_id
  GROUP BY g.version
)""") + """
SELECT version, CAST(CASE WHEN version = 'v2' THEN 200 ELSE 100 END AS BIGINT) AS evaluated_at, n_queries,
       round(CAST(top1_accuracy AS DOUBLE), 6) AS top1_accuracy, round(CAST(mrr AS DOUBLE), 6) AS mrr
FROM (SELECT * FROM deval WHERE version <> 'v2' UNION ALL SELECT * FROM deval10)""",
        "promote_gate": _with(DENSE, SCENARIO) + "\nUNION ALL\n".join([
            "SELECT 1 AS step, 'v1' AS version, a0 AS previous, false AS gated, CAST(NULL AS BOOLEAN) AS shadow_pass, "
            "true AS promoted, CAST(NULL AS VARCHAR) AS reason, true AS is_built, a1 AS active FROM st",
            gate_row(2, "v2", "a1", "p2", "a2"), gate_row(3, "v3", "a2", "p3", "a3"),
            gate_row(5, "v3", "a4", "p5", "a5")]),
        "rollback": _with(DENSE, SCENARIO) + (
            "SELECT 4 AS step, true AS rolled_back, a3 AS from_version, 'v2' AS to_version FROM st"),
        "shadow_log": _with(DENSE, SCENARIO) + "\nUNION ALL\n".join([
            shadow_row(2, "a1", "v2"), shadow_row(3, "a2", "v3"), shadow_row(5, "a4", "v3")]),
        "active_version": _with(DENSE, SCENARIO) + "\nUNION ALL\n".join(
            [f"SELECT {i} AS step, a{i} AS active_version FROM st" for i in range(6)]),
    }


QUERIES = """
cust AS (
  SELECT c_custkey AS q, 'app-' || CAST(c_custkey % 25 AS VARCHAR) AS app_id, coalesce(n, 0) AS n,
         coalesce(t, 0) * 1000 AS left_bytes, (CAST(floor(c_acctbal) AS BIGINT) + 1000) * 2000 AS right_bytes
  FROM customer LEFT JOIN (
    SELECT o_custkey, count(*) AS n, CAST(floor(sum(CAST(o_totalprice AS DECIMAL(15,2)))) AS BIGINT) AS t
    FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey
),
queries AS (
  SELECT *, CASE WHEN q % 7 = 3 THEN n ELSE n * 50 END AS files,
         CASE WHEN q % 7 = 3 THEN n * 512 WHEN q % 5 = 0 THEN n * 50 ELSE n * 50 * 64 END AS file_mb,
         CASE WHEN q % 7 = 3 THEN n ELSE n * 100 END AS tasks,
         CASE q % 8 WHEN 2 THEN 'ShuffledHashJoin' WHEN 5 THEN 'BroadcastNestedLoopJoin'
                    WHEN 6 THEN 'CartesianProduct' WHEN 7 THEN 'BroadcastHashJoin' ELSE 'SortMergeJoin' END AS name,
         CASE q % 8 WHEN 2 THEN left_bytes WHEN 3 THEN right_bytes WHEN 4 THEN NULL
                    ELSE least(left_bytes, right_bytes) END AS small
  FROM cust
)"""


def _plans() -> dict[str, str]:
    none = "CAST(NULL AS DOUBLE)"
    return {
        "parse_plans": _with(QUERIES) + """
SELECT app_id, q AS execution_id, v.node_id, v.parent_id, coalesce(v.name, queries.name) AS name, v.n_metrics
FROM queries, (VALUES (0, NULL, 'AdaptiveSparkPlan', 0), (1, 0, NULL, 3), (2, 1, 'Sort', 0), (3, 2, 'ShuffleQueryStage', 0),
  (4, 3, 'Exchange', 1), (5, 4, 'Scan parquet t', 3), (6, 1, 'Sort', 0), (7, 6, 'ShuffleQueryStage', 0),
  (8, 7, 'Exchange', 1), (9, 8, 'Scan parquet t', 3)) v(node_id, parent_id, name, n_metrics)""",
        "detect_join_strategy": _with(QUERIES) + f"""
SELECT app_id, 'MISSED_BROADCAST' AS code,
       CASE WHEN greatest(left_bytes, right_bytes) >= 1073741824 THEN 'ERROR' ELSE 'WARN' END AS severity,
       q * 10 + 3 AS stage_id, CAST(0 AS BIGINT) AS attempt, CAST(q AS DOUBLE) AS execution_id, 1.0::DOUBLE AS node_id,
       CAST(small AS DOUBLE) AS small_bytes, CAST(greatest(left_bytes, right_bytes) AS DOUBLE) AS other_bytes,
       10485760.0::DOUBLE AS broadcast_bytes, {none} AS output_rows
FROM queries WHERE name IN ('SortMergeJoin', 'ShuffledHashJoin') AND small <= 10485760
UNION ALL
SELECT app_id, 'NESTED_LOOP_JOIN', CASE WHEN name = 'CartesianProduct' THEN 'ERROR' ELSE 'WARN' END,
       q * 10 + 3, 0, q, 1.0, {none}, {none}, {none}, CAST(n * n * 2 AS DOUBLE)
FROM queries WHERE name IN ('BroadcastNestedLoopJoin', 'CartesianProduct')""",
        "detect_file_layout": _with(QUERIES) + f"""
SELECT app_id, 'SMALL_FILES' AS code, CASE WHEN files >= 1000 THEN 'ERROR' ELSE 'WARN' END AS severity,
       q * 10 + 1 AS stage_id, CAST(0 AS BIGINT) AS attempt, CAST(q AS DOUBLE) AS execution_id, 5.0::DOUBLE AS node_id,
       CAST(files AS DOUBLE) AS files, round(CAST(file_mb AS DOUBLE) / files, 6) AS mean_mb, {none} AS num_tasks
FROM queries WHERE files >= 100 AND file_mb / files < 32
UNION ALL
SELECT app_id, 'UNSPLITTABLE_FILES', 'WARN', q * 10 + 1, 0, q, 5.0, files, round(CAST(file_mb AS DOUBLE) / files, 6),
       CAST(tasks AS DOUBLE)
FROM queries WHERE files > 0 AND file_mb / files > 256 AND tasks > 0 AND tasks <= files""",
    }


ORACLE_SQL: dict[str, str] = {}
ORACLE_SQL.update(_profile())
ORACLE_SQL.update(_plans())
ORACLE_SQL.update(_extra())
ORACLE_SQL.update(_retrieval())
ORACLE_SQL.update(_lifecycle())

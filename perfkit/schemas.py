"""Schemas of the tables this library reads and writes."""

from pyspark.sql import types as T

L, I, D, S, B = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.BooleanType()


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


EVENT_LINES = _st(("log_id", S), ("value", S))
APPS = _st(("log_id", S), ("app_id", S), ("app_name", S))
TASKS = _st(("log_id", S), ("stage_id", L), ("attempt", L), ("task_id", L), ("duration_ms", L),
            ("gc_time_ms", L), ("shuffle_read_bytes", L), ("shuffle_write_bytes", L),
            ("spill_mem_bytes", L), ("spill_disk_bytes", L))
STAGES = _st(("log_id", S), ("stage_id", L), ("attempt", L), ("name", S), ("num_tasks", L),
             ("submission_time_ms", L), ("completion_time_ms", L))
CONFS = _st(("app_id", S), ("conf", T.MapType(S, S)))
CLUSTERS = _st(("app_id", S), ("nodes", I), ("cores_per_node", I), ("memory_gb_per_node", D),
               ("rate_per_node_hour", D), ("rate_per_dbu_hour", D), ("dbus_per_node", D))
COST_INPUTS = _st(("app_id", S), ("scenario", S), ("runtime_seconds", L), ("nodes", L),
                  ("rate_per_node_hour", D), ("dbus_per_node", D), ("rate_per_dbu_hour", D))

# Registry (embedding lifecycle) tables.
DOCS = _st(("doc_id", L), ("title", S), ("body", S), ("updated_at", L))
GOLDEN = _st(("qid", L), ("query", S), ("expected_doc_id", L))
GOLDEN_VECTORS = _st(("qid", L), ("query_vec", T.ArrayType(T.FloatType())), ("expected_doc_id", L))
BUILDS = _st(("version", S), ("built_at", L), ("doc_count", L))
DENSE_VECTORS = _st(("version", S), ("doc_id", L), ("embedding", T.ArrayType(T.FloatType())))
SPARSE_VECTORS = _st(("version", S), ("doc_id", L), ("indices", T.ArrayType(I)),
                     ("counts", T.ArrayType(L)))
EVAL_RESULTS = _st(("version", S), ("evaluated_at", L), ("n_queries", L), ("top1_accuracy", D),
                   ("mrr", D))
SHADOW_RESULTS = _st(("baseline_version", S), ("candidate_version", S), ("evaluated_at", L),
                     ("baseline_top1", D), ("candidate_top1", D), ("baseline_mrr", D),
                     ("candidate_mrr", D), ("pass", B))
VERSION_EVENTS = _st(("event_seq", L), ("kind", S), ("version", S), ("at", L))

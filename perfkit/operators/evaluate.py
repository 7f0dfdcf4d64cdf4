"""Golden-set evaluation and the shadow gate.

``golden_v`` is the golden set under each version being evaluated:
``(version, qid, expected_doc_id)`` (the same rows the queries were embedded
from), so a query with no hit in the top k still counts, as a miss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Gate defaults.
MIN_SCORE = 0.60
ALLOWED_DROP = 0.02


def per_query(hits: DataFrame, golden_v: DataFrame) -> DataFrame:
    """Rank of the expected document in each query's hits, null when absent."""
    found = hits.select("version", "qid", F.col("doc_id").alias("expected_doc_id"), "rank")
    return golden_v.select("version", "qid", "expected_doc_id").join(
        found, ["version", "qid", "expected_doc_id"], "left")


def evaluate(hits: DataFrame, golden_v: DataFrame, evaluated_at: int = 0) -> DataFrame:
    """``(version, evaluated_at, n_queries, top1_accuracy, mrr)`` per version."""
    pq = per_query(hits, golden_v)
    return pq.groupBy("version").agg(
        F.count("*").alias("n_queries"),
        F.avg(F.when(F.col("rank") == 1, 1.0).otherwise(0.0)).alias("top1_accuracy"),
        F.avg(F.coalesce(1.0 / F.col("rank"), F.lit(0.0))).alias("mrr"),
    ).select("version", F.lit(int(evaluated_at)).cast("bigint").alias("evaluated_at"),
             "n_queries", "top1_accuracy", "mrr")


def shadow_compare(evals: DataFrame, pairs: DataFrame, min_score: float = MIN_SCORE,
                   allowed_drop: float = ALLOWED_DROP, evaluated_at: int = 0) -> DataFrame:
    """Gate each ``(baseline_version, candidate_version)`` pair.

    Pass when, for top-1 and for MRR alike, candidate >= max(min_score,
    baseline - allowed_drop) (N11).
    """
    e = evals.select("version", "top1_accuracy", "mrr")
    b = e.select(F.col("version").alias("baseline_version"), F.col("top1_accuracy").alias("baseline_top1"),
                 F.col("mrr").alias("baseline_mrr"))
    c = e.select(F.col("version").alias("candidate_version"),
                 F.col("top1_accuracy").alias("candidate_top1"), F.col("mrr").alias("candidate_mrr"))
    j = pairs.join(b, "baseline_version").join(c, "candidate_version")

    def ok(cand: str, base: str):
        return F.col(cand) >= F.greatest(F.lit(float(min_score)), F.col(base) - F.lit(float(allowed_drop)))

    return j.select(
        "baseline_version", "candidate_version",
        F.lit(int(evaluated_at)).cast("bigint").alias("evaluated_at"),
        "baseline_top1", "candidate_top1", "baseline_mrr", "candidate_mrr",
        (ok("candidate_top1", "baseline_top1") & ok("candidate_mrr", "baseline_mrr")).alias("pass"))

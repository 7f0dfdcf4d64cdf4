"""Build -> evaluate -> shadow -> promote / roll back, as one chain of DataFrames.

``run_steps`` applies a sequence of registry operations to an event log and
returns every decision, the shadow log and the active version after each step.
Gated promotions compare the candidate with the version active at that moment.
The evaluation results (expensive lineage: the search) and each step's event log
are checkpointed to the shared ``spark.checkpoint.dir``, the in-job analogue of
appending to the registry tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfkit import schemas as sc
from perfkit.operators import evaluate as evl
from perfkit.operators import versions as vs
from perfkit.session import checkpoint_dir

# The operation sequence of the registered lifecycle queries.
# (kind, version, gated)
DEFAULT_STEPS = [("promote", "v1", False), ("promote", "v2", True), ("promote", "v3", True),
                 ("rollback", "v2", None), ("promote", "v3", True)]


def run_steps(evals: DataFrame, builds: DataFrame | None, steps=DEFAULT_STEPS,
              events: DataFrame | None = None, start_at: int = 1000,
              min_score: float = evl.MIN_SCORE, allowed_drop: float = evl.ALLOWED_DROP) -> dict:
    spark = evals.sparkSession
    checkpoint_dir(spark)
    evals = evals.checkpoint(eager=True)
    if events is None:
        events = spark.createDataFrame([], sc.VERSION_EVENTS)
    decisions, rollbacks, shadows = [], [], []
    actives = [vs.registry_state(events).select(F.lit(0).alias("step"), "active_version")]
    for i, (kind, version, gated) in enumerate(steps, 1):
        at = start_at + i
        if kind == "promote":
            shadow = None
            if gated:
                pair = vs.registry_state(events).select(
                    F.col("active_version").alias("baseline_version"),
                    F.lit(version).alias("candidate_version"))
                shadow = evl.shadow_compare(evals, pair, min_score, allowed_drop, evaluated_at=at)
                shadows.append(shadow.withColumn("step", F.lit(i)))
            d, ev = vs.promote(events, version, at, shadow, builds)
            decisions.append(d.withColumn("step", F.lit(i)))
        elif kind == "rollback":
            d, ev = vs.rollback(events, version, at)
            rollbacks.append(d.withColumn("step", F.lit(i)))
        else:
            raise ValueError(f"unknown step kind {kind!r}")
        events = events.unionByName(ev).checkpoint(eager=True)
        actives.append(vs.registry_state(events).select(F.lit(i).alias("step"), "active_version"))

    def union(frames):
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    return {
        "decisions": union(decisions) if decisions else None,
        "rollbacks": union(rollbacks) if rollbacks else None,
        "shadow_log": union(shadows) if shadows else None,
        "active": union(actives),
        "events": events,
    }

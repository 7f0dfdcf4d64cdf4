"""Version lifecycle as pure DataFrame functions.

State lives in append-only tables; "latest wins" is a window (W2) and the active
version is the last ``version_events`` row (or ``v1`` when there is none). Each
operation returns the rows it would append, so a decision and its effect are one
lazy plan; ``perfkit.sources.registry`` persists them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Bootstrap active version and event kinds.
DEFAULT_ACTIVE = "v1"
PROMOTE, ROLLBACK = "promote", "rollback"


def latest(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """The last row per ``key`` by ``order`` (columns, newest first)."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def upsert_docs(current: DataFrame, batch: DataFrame, now: int | None = None) -> DataFrame:
    """Documents after upserting ``batch`` (``doc_id, title, body``), stamped ``now``.

    Later rows win: by ``updated_at``, then batch over current for equal stamps, then the greatest
    body and title of rows that repeat an id within the batch.
    """
    b = batch.select("doc_id", "title", "body",
                     (F.lit(int(now)).cast("bigint") if now is not None
                      else F.col("updated_at").cast("bigint")).alias("updated_at"))
    u = current.select("doc_id", "title", "body", "updated_at", F.lit(0).alias("_src")) \
               .unionByName(b.withColumn("_src", F.lit(1)))
    return latest(u, ["doc_id"], [F.desc("updated_at"), F.desc("_src"), F.desc("body"), F.desc("title")]).drop("_src")


def scan_docs(docs: DataFrame) -> DataFrame:
    """``(doc_id, title, body)``; order by ``doc_id`` only when output order matters."""
    return docs.select("doc_id", "title", "body")


def _newest(df: DataFrame, stamp: str) -> list:
    """Newest first by a stamp, then by the order of writing where the rows have it."""
    return [F.desc(stamp), *[F.desc(c) for c in df.columns if c == "write_seq"]]


def builds_latest(builds: DataFrame) -> DataFrame:
    """V5: latest build row per version."""
    return latest(builds, ["version"], _newest(builds, "built_at"))


def evals_latest(evals: DataFrame) -> DataFrame:
    """V4: latest evaluation row per version."""
    return latest(evals, ["version"], _newest(evals, "evaluated_at"))


def registry_state(events: DataFrame) -> DataFrame:
    """One row ``(active_version, last_seq)``; ``v1`` / 0 when no events.

    A global aggregate, so it yields exactly one row even over an empty log.
    """
    s = events.agg(F.max_by("version", "event_seq").alias("a"), F.max("event_seq").alias("m"))
    return s.select(F.coalesce("a", F.lit(DEFAULT_ACTIVE)).alias("active_version"),
                    F.coalesce("m", F.lit(0).cast("bigint")).alias("last_seq"))


def _event(state: DataFrame, kind: str, version: str, at: int, when=None) -> DataFrame:
    ev = state.select((F.col("last_seq") + 1).alias("event_seq"), F.lit(kind).alias("kind"),
                      F.lit(version).alias("version"), F.lit(int(at)).cast("bigint").alias("at"))
    return ev if when is None else ev.where(when)


def promote(events: DataFrame, version: str, at: int, shadow: DataFrame | None = None,
            builds: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Decide a promotion; returns ``(decision, events_to_append)``.

    Without ``shadow`` the promotion is ungated (N12: any name is accepted;
    ``is_built`` reports whether a build exists). With ``shadow`` (output of
    ``evaluate.shadow_compare``) it goes ahead only if the row for
    (active, version) passes; otherwise the reason is ``shadow_eval_failed``.
    """
    state = registry_state(events)
    d = state.select(F.lit(version).alias("version"), F.col("active_version").alias("previous"), "last_seq")
    if shadow is not None:
        s = shadow.where(F.col("candidate_version") == version).select(
            F.col("baseline_version").alias("previous"), F.col("pass").alias("shadow_pass"))
        d = d.join(s, "previous", "left")
        ok = F.coalesce(F.col("shadow_pass"), F.lit(False))
        d = d.select("*", F.lit(True).alias("gated"), ok.alias("promoted"))
    else:
        d = d.select("*", F.lit(None).cast("boolean").alias("shadow_pass"), F.lit(False).alias("gated"),
                     F.lit(True).alias("promoted"))
    if builds is not None:
        built = builds.where(F.col("version") == version).select("version").distinct() \
                      .withColumn("is_built", F.lit(True))
        d = d.join(built, "version", "left").withColumn("is_built", F.coalesce("is_built", F.lit(False)))
    else:
        d = d.withColumn("is_built", F.lit(None).cast("boolean"))
    d = d.select("version", "previous", "gated", "shadow_pass", "promoted",
                 F.when(~F.col("promoted"), F.lit("shadow_eval_failed")).alias("reason"), "is_built",
                 F.when(F.col("promoted"), F.lit(version)).otherwise(F.col("previous")).alias("active"),
                 "last_seq")
    ev = d.where("promoted").select((F.col("last_seq") + 1).alias("event_seq"), F.lit(PROMOTE).alias("kind"),
                                    F.lit(version).alias("version"),
                                    F.lit(int(at)).cast("bigint").alias("at"))
    return d.drop("last_seq"), ev


def rollback(events: DataFrame, version: str, at: int) -> tuple[DataFrame, DataFrame]:
    """Switch back to ``version`` ungated; returns ``(decision, events_to_append)``."""
    state = registry_state(events)
    d = state.select(F.lit(True).alias("rolled_back"), F.col("active_version").alias("from_version"),
                     F.lit(version).alias("to_version"))
    return d, _event(state, ROLLBACK, version, at)

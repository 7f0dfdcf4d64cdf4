"""Spark configuration and cluster inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfkit.functions.conf_values import conf_bool, conf_bytes, conf_int

# Configuration keys and their defaults as the profiler reads them.
SHUFFLE_PARTITIONS = ("spark.sql.shuffle.partitions", 200)
DEFAULT_PARALLELISM = ("spark.default.parallelism", 0)
AQE_ENABLED = ("spark.sql.adaptive.enabled", False)
SKEW_JOIN_ENABLED = ("spark.sql.adaptive.skewJoin.enabled", False)


def read_conf_texts(spark: SparkSession, paths: str | list[str], by: str = "file") -> DataFrame:
    """The text of each conf file: ``(app_id, json)``.

    The application id is the file name without its extension (``<app_id>.json``),
    or with ``by="dir"`` the name of the folder holding the file (``<app_id>/...``).
    Files are small, so each is read whole. Folders are read recursively.
    """
    raw = spark.read.option("recursiveFileLookup", "true").text(paths, wholetext=True)
    path = F.col("_metadata.file_path")
    app = (F.regexp_extract(path, r"([^/=]+)/[^/]*$", 1) if by == "dir"
           else F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1))
    return raw.select(app.alias("app_id"), F.col("value").alias("json"))


def read_confs(spark: SparkSession, paths: str | list[str], by: str = "file") -> DataFrame:
    """One JSON object per file -> ``(app_id, conf map<string,string>)``; see ``parse_confs``."""
    return parse_confs(read_conf_texts(spark, paths, by))


def _parsed(raw: DataFrame) -> DataFrame:
    blank = F.coalesce(F.regexp_replace("json", r"\s+", "") == "", F.lit(True))
    conf = F.when(blank, F.create_map().cast("map<string,string>")).otherwise(
        F.from_json("json", "map<string,string>"))
    whole = blank | F.try_parse_json("json").isNotNull()
    return raw.select("app_id", "json", F.when(whole, conf).alias("conf"))


def parse_confs(raw: DataFrame) -> DataFrame:
    """``(app_id, json)`` -> ``(app_id, conf)``. A null or blank text is an empty conf; a text that is
    no JSON object is not here but in ``rejected_confs``."""
    return _parsed(raw).where(F.col("conf").isNotNull()).select("app_id", "conf")


def rejected_confs(raw: DataFrame) -> DataFrame:
    """``(app_id, json)`` of the texts that are no JSON object."""
    return _parsed(raw).where(F.col("conf").isNull()).select("app_id", "json")


def conf_long(confs: DataFrame) -> DataFrame:
    """Long form ``(app_id, key, value)``."""
    return confs.select("app_id", F.explode("conf").alias("key", "value"))


def conf_typed(confs: DataFrame) -> DataFrame:
    """The four settings the profiler uses, typed, one row per application."""
    c = F.col("conf")
    return confs.select(
        "app_id",
        conf_int(c, *SHUFFLE_PARTITIONS).alias("shuffle_partitions"),
        conf_int(c, *DEFAULT_PARALLELISM).alias("default_parallelism"),
        conf_bool(c, *AQE_ENABLED).alias("aqe_enabled"),
        conf_bool(c, *SKEW_JOIN_ENABLED).alias("skew_join_enabled"))


def broadcast_limits(confs: DataFrame) -> DataFrame:
    """``(app_id, broadcast_bytes)``: the largest table that the application lets Spark broadcast."""
    limit = conf_bytes(F.col("conf"), "spark.sql.autoBroadcastJoinThreshold", 10 * 1024 * 1024)
    return confs.select("app_id", limit.alias("broadcast_bytes"))


def _valid(clusters: DataFrame):
    return ((F.col("nodes") >= 1) & (F.col("cores_per_node") >= 1)
            & (F.col("memory_gb_per_node") > 0) & (F.col("rate_per_node_hour") >= 0)
            & (F.col("rate_per_dbu_hour") >= 0) & (F.col("dbus_per_node") >= 0))


def cluster_check(clusters: DataFrame) -> DataFrame:
    """Every cluster row with ``valid`` and the name of the first failed check."""
    reason = (F.when(F.col("nodes").isNull() | (F.col("nodes") < 1), "nodes must be >= 1")
              .when(F.col("cores_per_node").isNull() | (F.col("cores_per_node") < 1),
                    "cores_per_node must be >= 1")
              .when(F.col("memory_gb_per_node").isNull() | (F.col("memory_gb_per_node") <= 0),
                    "memory_gb_per_node must be > 0")
              .when(F.col("rate_per_node_hour") < 0, "rate_per_node_hour must be >= 0")
              .when(F.col("rate_per_dbu_hour") < 0, "rate_per_dbu_hour must be >= 0")
              .when(F.col("dbus_per_node") < 0, "dbus_per_node must be >= 0"))
    return clusters.withColumn("valid", F.coalesce(_valid(clusters), F.lit(False))) \
                   .withColumn("reason", reason)


def valid_clusters(clusters: DataFrame) -> DataFrame:
    return clusters.where(F.coalesce(_valid(clusters), F.lit(False)))


def rejected_clusters(clusters: DataFrame) -> DataFrame:
    return cluster_check(clusters).where(~F.col("valid"))


def app_settings(confs: DataFrame, clusters: DataFrame) -> DataFrame:
    """Typed conf joined to each valid cluster, with ``cores_total``.

    An application with a cluster but no conf file gets the defaults (empty conf).
    """
    typed = conf_typed(confs)
    cl = valid_clusters(clusters).select(
        "app_id", (F.col("nodes").cast("bigint") * F.col("cores_per_node")).alias("cores_total"))
    j = cl.join(typed, "app_id", "left")
    return j.select(
        "app_id", "cores_total",
        F.coalesce("shuffle_partitions", F.lit(SHUFFLE_PARTITIONS[1]).cast("bigint")).alias("shuffle_partitions"),
        F.coalesce("default_parallelism", F.lit(DEFAULT_PARALLELISM[1]).cast("bigint")).alias("default_parallelism"),
        F.coalesce("aqe_enabled", F.lit(AQE_ENABLED[1])).alias("aqe_enabled"),
        F.coalesce("skew_join_enabled", F.lit(SKEW_JOIN_ENABLED[1])).alias("skew_join_enabled"))

"""Version registry on shared storage (S7-S13): one parquet folder per table.

Tables are append-only (docs, builds, eval_results, shadow_results,
version_events) except the golden set (replaced whole, S8). Every build of vector
artifacts has a folder of its own, partitioned by ``version`` (S9, S11), and is
readable once its row is in ``builds``: a build that fails leaves the one before in
place. Nothing is rewritten while being read: derived views (latest document,
active version) are computed on read. Appends to documents, builds and evaluations
are numbered (``write_seq``), so the last write wins whatever the clock says; a
registry has one writer at a time.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfkit import schemas as sc
from perfkit.operators import versions as vs
from perfkit.operators.embed import build_rows
from perfkit.session import path_exists

TABLES = {
    "docs": sc.DOCS, "golden": sc.GOLDEN, "builds": sc.BUILDS, "eval_results": sc.EVAL_RESULTS,
    "shadow_results": sc.SHADOW_RESULTS, "version_events": sc.VERSION_EVENTS,
}


#: Columns that the registry adds to its stored tables.
KEPT = {"docs": "write_seq bigint", "builds": "write_seq bigint, build string", "eval_results": "write_seq bigint"}


class Registry:
    """Tables under ``root`` (a shared path: HDFS, object store, or local in tests)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def _stored(self, name: str) -> DataFrame:
        """A table with the registry's own columns, empty when it was never written."""
        schema = T.StructType(TABLES[name].fields + T.StructType.fromDDL(KEPT.get(name, "")).fields)
        if path_exists(self.spark, self.path(name)):
            return self.spark.read.schema(schema).parquet(self.path(name))
        return self.spark.createDataFrame([], schema)

    def read(self, name: str) -> DataFrame:
        """A table, or an empty frame of its schema when it was never written."""
        return self._stored(name).select(*TABLES[name].names)

    def append(self, name: str, rows: DataFrame, **own: str) -> None:
        out = rows.select(*TABLES[name].names)
        if name in KEPT:
            last = self._stored(name).agg(F.max("write_seq")).first()[0] or 0
            out = out.withColumns({"write_seq": F.lit(last + 1).cast("bigint"), **{k: F.lit(v) for k, v in own.items()}})
        out.write.mode("append").parquet(self.path(name))

    # S8
    def replace_golden(self, golden: DataFrame) -> None:
        golden.select("qid", "query", "expected_doc_id").write.mode("overwrite").parquet(self.path("golden"))

    # S7
    def golden(self) -> DataFrame:
        g = self.read("golden")
        if g.isEmpty():
            raise RuntimeError("no golden queries; load them first")
        return g

    # S5, S6
    def upsert_docs(self, batch: DataFrame, now: int) -> None:
        """Append the batch stamped ``now``; readers take the latest row per id."""
        b = batch.select("doc_id", "title", "body", F.lit(int(now)).cast("bigint").alias("updated_at"))
        self.append("docs", b)

    def docs(self) -> DataFrame:
        """The last written row of each id; of rows of one batch the one with the greatest body, then
        the greatest title."""
        order = [F.desc("write_seq"), F.desc("body"), F.desc("title")]
        return vs.latest(self._stored("docs"), ["doc_id"], order).drop("write_seq")

    # vectors/build=<id>/version=<v>/
    def write_vectors(self, vectors: DataFrame, built_at: int) -> DataFrame:
        """Write the artifacts to a new folder, count what was written, then log the build; returns the
        logged rows. The vectors are computed once."""
        build = uuid.uuid4().hex
        folder = os.path.join(self.path("vectors"), f"build={build}")
        vectors.write.partitionBy("version").parquet(folder)
        # With its schema given, an all-digit version is not read back as a number.
        written = self.spark.read.schema(vectors.schema).parquet(folder)
        rows = build_rows(written, built_at)
        self.append("builds", rows, build=build)
        return rows

    # S10
    def read_vectors(self, version: str) -> DataFrame:
        """The vectors of the last logged build of a version."""
        last = vs.builds_latest(self._stored("builds").where(F.col("version") == version)).first()
        if last is None:
            raise FileNotFoundError(f"no artifacts for version={version}")
        folder = os.path.join(self.path("vectors"), f"build={last['build']}")
        found = self.spark.read.parquet(folder).schema
        kept = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "version" else f for f in found])
        return self.spark.read.schema(kept).parquet(folder).where(F.col("version") == version)

    # S13, V6
    def active_version(self) -> str:
        return vs.registry_state(self.read("version_events")).first()["active_version"]

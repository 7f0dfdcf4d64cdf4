"""Fixture logs: small compressed files, written without a sort."""

import glob
import gzip

from pyspark.sql import functions as F

from perfkit import fixtures as fx
from perfkit.sources import eventlog as ev

SF = "/root/testdata/sf0.001"
KEY = "spark.sql.maxConcurrentOutputFileWriters"


def test_logs_are_compressed_whole_and_in_small_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fx, "LINES_PER_FILE", 1000)
    before = spark.conf.get(KEY, None)
    lines = fx.eventlog_lines(spark, SF)
    fx._write_logs(lines, str(tmp_path / "logs"))
    assert spark.conf.get(KEY, None) == before
    files = glob.glob(f"{tmp_path}/logs/log=*/part-*")
    assert files and all(f.endswith(".gz") for f in files)
    assert max(gzip.open(f, "rt").read().count("\n") for f in files) <= 1000
    read = ev.read_eventlog(spark, str(tmp_path / "logs"), rolled=True)
    read = read.select(F.substring_index("log_id", "log=", -1).alias("log_id"), "value")
    assert read.exceptAll(lines).isEmpty() and lines.exceptAll(read).isEmpty()

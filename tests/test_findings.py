import pytest

from perfkit.operators import findings as fd

COLS = ("app_id string, stage_id bigint, attempt bigint, name string, num_tasks bigint, "
        "stage_duration_ms bigint, task_p50_ms double, task_p95_ms double, task_max_ms bigint, "
        "skew_ratio_p95_p50 double, skew_ratio_max_p50 double, gc_pct double, shuffle_read_mb double, "
        "shuffle_write_mb double, spill_mb double")


def metrics(spark, **kw):
    base = dict(app_id="a", stage_id=1, attempt=0, name="x", num_tasks=48, stage_duration_ms=6400,
                task_p50_ms=80.0, task_p95_ms=112.0, task_max_ms=136, skew_ratio_p95_p50=1.4,
                skew_ratio_max_p50=1.7, gc_pct=0.01, shuffle_read_mb=0.0, shuffle_write_mb=0.0, spill_mb=0.0)
    base.update(kw)
    return spark.createDataFrame([tuple(base[c.split()[0]] for c in COLS.split(", "))], COLS)


def codes(df):
    return sorted((r["code"], r["severity"]) for r in df.collect())


@pytest.mark.parametrize("r95,rmax,tasks,expect", [
    (2.99, 7.99, 200, []), (3.0, 1.0, 200, [("SKEW_DETECTED", "WARN")]),
    (1.0, 8.0, 200, [("SKEW_DETECTED", "WARN")]), (1.0, 15.99, 200, [("SKEW_DETECTED", "WARN")]),
    (1.0, 16.0, 200, [("SKEW_DETECTED", "ERROR")]), (9.0, 30.0, 9, []), (9.0, 30.0, 10, [("SKEW_DETECTED", "ERROR")]),
])
def test_skew_boundaries(spark, r95, rmax, tasks, expect):
    m = metrics(spark, skew_ratio_p95_p50=r95, skew_ratio_max_p50=rmax, num_tasks=tasks)
    assert codes(fd.detect_skew(m)) == expect


@pytest.mark.parametrize("rd,wr,expect", [(1023.0, 0.0, []), (512.0, 512.0, [("SHUFFLE_HEAVY", "WARN")]),
                                          (5119.0, 0.0, [("SHUFFLE_HEAVY", "WARN")]),
                                          (5120.0, 0.0, [("SHUFFLE_HEAVY", "ERROR")])])
def test_shuffle_boundaries(spark, rd, wr, expect):
    assert codes(fd.detect_shuffle_heavy(metrics(spark, shuffle_read_mb=rd, shuffle_write_mb=wr))) == expect


@pytest.mark.parametrize("spill,gc,expect", [
    (511.9, 0.099, []), (512.0, 0.0, [("SPILL_DETECTED", "WARN")]), (2560.0, 0.0, [("SPILL_DETECTED", "ERROR")]),
    (0.0, 0.1, [("GC_PRESSURE", "WARN")]), (0.0, 0.2, [("GC_PRESSURE", "ERROR")]),
    (3000.0, 0.15, [("GC_PRESSURE", "WARN"), ("SPILL_DETECTED", "ERROR")]),
])
def test_spill_gc_boundaries(spark, spill, gc, expect):
    assert codes(fd.detect_spill_gc(metrics(spark, spill_mb=spill, gc_pct=gc))) == expect


def test_findings_all_single_pass_equals_detectors(spark):
    m = metrics(spark, skew_ratio_p95_p50=5.0, skew_ratio_max_p50=20.0, shuffle_read_mb=6000.0,
                spill_mb=600.0, gc_pct=0.5)
    one = codes(fd.findings_all(m))
    sep = codes(fd.detect_skew(m)) + codes(fd.detect_shuffle_heavy(m)) + codes(fd.detect_spill_gc(m))
    assert one == sorted(sep) and len(one) == 4


SET = "app_id string, cores_total bigint, shuffle_partitions bigint, default_parallelism bigint"


@pytest.mark.parametrize("cores,parts,par,expect", [
    (40, 200, 64, []),                       # the reference sample conf with 10 x 4 cores
    (40, 800, 0, ["OVER_PARTITIONED"]), (40, 799, 0, []),
    (40, 10, 0, ["UNDER_PARTITIONED"]), (40, 11, 0, []),
    (100, 25, 25, ["LOW_DEFAULT_PARALLELISM", "UNDER_PARTITIONED"]), (100, 26, 26, []),
    (4, 8, 8, ["LOW_DEFAULT_PARALLELISM", "UNDER_PARTITIONED"]),
    (None, 8, 8, []),                        # cores unknown: no partition findings
])
def test_partitioning_boundaries(spark, cores, parts, par, expect):
    s = spark.createDataFrame([("a", cores, parts, par)], SET)
    got = sorted(r["code"] for r in fd.detect_partitioning(s).collect())
    assert got == expect

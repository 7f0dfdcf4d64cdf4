import json
import os

import numpy as np
import pytest

from perfkit.operators import embed as em
from perfkit.operators import search as se
from perfkit.plans import profile as pf
from tests.test_eventlog import stage, start, task


def test_profile_plan_writes_report_and_json(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    rows = [start("app-1", "job", 1), stage(1, n=20)] + [
        task(tid=i, launch=0, finish=(2000 if i == 0 else 100)) for i in range(20)]
    (logs / "app-1.log").write_text("\n".join(rows))
    confs = tmp_path / "confs"
    confs.mkdir()
    (confs / "app-1.json").write_text(json.dumps({"spark.sql.shuffle.partitions": "8"}))
    clusters = spark.createDataFrame([("app-1", 10, 4, 16.0, 0.45, 0.0, 0.0)],
                                     "app_id string, nodes int, cores_per_node int, memory_gb_per_node double, "
                                     "rate_per_node_hour double, rate_per_dbu_hour double, dbus_per_node double")
    out = pf.profile(spark, str(logs), str(confs), clusters)
    codes = sorted(r["code"] for r in out["findings"].collect())
    assert codes == ["SKEW_DETECTED", "UNDER_PARTITIONED"]
    c = out["cost"].first()                     # runtime from the log: 1000 ms -> 1 s
    assert (c["scenario"], c["runtime_seconds"], c["nodes"]) == ("observed", 1, 10)
    assert abs(c["estimated_cost"] - 10 / 3600 * 0.45) < 1e-12
    dest = str(tmp_path / "out")
    pf.write_outputs(out, dest)
    rep = open([os.path.join(dp, f) for dp, _, fs in os.walk(f"{dest}/report") for f in fs
                if f.startswith("part-")][0]).read()
    assert rep.startswith("Profile of job (app-1)") and "UNDER_PARTITIONED" in rep
    recs = [json.loads(line) for dp, _, fs in os.walk(f"{dest}/recommendations") for f in fs
            if f.startswith("part-") for line in open(os.path.join(dp, f))]
    assert [r["severity"] for r in recs] == ["ERROR", "WARN"]


def test_plugin_embedder_and_empty_build(spark):
    docs = spark.createDataFrame([(1, "aaa"), (2, "bb"), (3, "c")], "doc_id bigint, text string")

    def factory():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    v = em.embed_with(docs, {"len": factory})
    q = spark.createDataFrame([("len", 9, [2.0, 1.0])], "version string, qid bigint, query_vec array<double>")
    top = se.topk(v, q, k=1, dims={"len": 2}).first()
    assert top["doc_id"] == 2
    with pytest.raises(ValueError):
        em.build_version(docs.where("doc_id < 0"), {"v": 8}, built_at=1)

from perfkit.operators import advice as adv
from perfkit.operators import evaluate as evl
from perfkit.operators import findings as fd
from perfkit.operators import report as rp
from perfkit.operators import search as se
from perfkit.operators.stage_metrics import profile_stages
from perfkit.sources import eventlog as ev
from tests.test_eventlog import start


def test_log_with_only_a_start_record(spark):
    lines = spark.createDataFrame([("L", start("app-1", "n", 1))], "log_id string, value string")
    m, apps = profile_stages(ev.parse_events(lines))
    assert m.count() == 0 and apps.count() == 1
    f = fd.findings_all(m)
    recs = adv.recommend(f)
    assert f.count() == 0 and recs.count() == 0
    lines_out = [r["line"] for r in rp.report_lines(apps, m, f, recs).collect()]
    assert "the log has no completed stage" in lines_out and "nothing to change" in lines_out


def test_version_without_documents_counts_misses(spark):
    docs = spark.createDataFrame([("a", 1, [1.0, 0.0])], "version string, doc_id bigint, embedding array<float>")
    q = spark.createDataFrame([("a", 7, [1.0, 0.0]), ("b", 7, [1.0, 0.0])],
                              "version string, qid bigint, query_vec array<double>")
    hits = se.topk(docs, q, k=5, dims={"a": 2, "b": 2})
    assert hits.where("version = 'b'").count() == 0
    golden = spark.createDataFrame([("a", 7, 1), ("b", 7, 1)], "version string, qid bigint, expected_doc_id bigint")
    e = {r["version"]: r for r in evl.evaluate(hits, golden).collect()}
    assert e["a"]["top1_accuracy"] == 1.0 and e["b"]["top1_accuracy"] == 0.0 and e["b"]["n_queries"] == 1

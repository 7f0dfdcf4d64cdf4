from pyspark.sql import functions as F

from perfkit import catalog
from perfkit.operators import embed as em
from perfkit.operators import evaluate as evl
from perfkit.operators import search as se
from perfkit.operators import versions as vs
from perfkit.plans import lifecycle as lc
from perfkit.sources.registry import Registry

# Our own five support articles and five queries; query i expects document i.
DOCS = [(1, "Password reset", "Open the reset page, confirm the mail link, choose a strong password."),
        (2, "Admin two-factor reset", "Confirm identity, remove old factors, enrol the new phone."),
        (3, "Sign-in loop after single sign-on", "Clear cookies, check the identity provider session, fix the redirect."),
        (4, "Locked account", "A user is locked out after the second factor expired; reset and enrol again."),
        (5, "Refund request", "Check the invoice, issue a credit note, confirm when the refund arrives.")]
GOLDEN = [(1, "reset password mail link", 1), (2, "admin two-factor enrol phone", 2),
          (3, "sign-in loop redirect cookies", 3), (4, "locked out second factor expired", 4),
          (5, "refund invoice credit note", 5)]


def _setup(spark, tmp_path, versions):
    reg = Registry(spark, str(tmp_path / "registry"))
    reg.upsert_docs(spark.createDataFrame(DOCS, "doc_id bigint, title string, body string"), now=1)
    reg.replace_golden(spark.createDataFrame(GOLDEN, "qid bigint, query string, expected_doc_id bigint"))
    docs = em.doc_text(reg.docs())
    reg.write_vectors(em.build_version(docs, versions, built_at=10)[0], 10)
    golden = reg.golden()
    q = em.embed_text(golden, versions, id_col="qid", text_col="query").withColumnRenamed("doc_id", "qid")
    vecs = reg.read_vectors(list(versions)[0])
    for v in list(versions)[1:]:
        vecs = vecs.unionByName(reg.read_vectors(v))
    hits = se.topk(vecs, q, k=5, dims=versions)
    gv = golden.select(F.explode(F.array(*[F.lit(v) for v in versions])).alias("version"), "qid",
                       "expected_doc_id")
    return reg, evl.evaluate(hits, gv), reg.read("builds")


def _run(reg, evals, builds, steps, **gate):
    out = lc.run_steps(evals, builds, steps, events=reg.read("version_events"), **gate)
    reg.append("version_events", out["events"].exceptAll(reg.read("version_events")))
    if out["shadow_log"] is not None:
        reg.append("shadow_results", out["shadow_log"])             # V8: append only
    reg.append("eval_results", evals)                                 # V4
    return out


def test_shadow_eval_then_promote(spark, tmp_path):
    reg, evals, builds = _setup(spark, tmp_path, {"v1": 256, "v2": 512})
    out = _run(reg, evals, builds, [("promote", "v1", False), ("promote", "v2", True)])
    d = {r["step"]: r for r in out["decisions"].collect()}
    passed = out["shadow_log"].first()["pass"]
    assert d[2]["promoted"] is passed
    assert reg.active_version() == ("v2" if passed else "v1")
    log = reg.read("shadow_results").collect()
    assert [(r["baseline_version"], r["candidate_version"], r["pass"]) for r in log] == [("v1", "v2", passed)]
    latest = {r["version"]: r for r in vs.evals_latest(reg.read("eval_results")).collect()}
    assert set(latest) == {"v1", "v2"} and latest["v1"]["n_queries"] == 5
    assert vs.builds_latest(builds).count() == 2


def test_candidate_blocked_on_regression(spark, tmp_path):
    # A two-bucket version cannot reach the strict floor of 0.99.
    reg, evals, builds = _setup(spark, tmp_path, {"v1": 256, "v2": 2})
    out = _run(reg, evals, builds, [("promote", "v1", False), ("promote", "v2", True)],
               min_score=0.99, allowed_drop=0.0)
    d = {r["step"]: r for r in out["decisions"].collect()}
    assert out["shadow_log"].first()["pass"] is False
    assert d[2]["promoted"] is False and d[2]["reason"] == "shadow_eval_failed"
    assert reg.active_version() == "v1"


def test_rollback_and_bootstrap(spark, tmp_path):
    reg = Registry(spark, str(tmp_path / "r2"))
    assert reg.active_version() == "v1"        # S13: default when nothing was promoted
    ev = reg.read("version_events")
    d, rows = vs.promote(ev, "v7", at=5)        # ungated: any name, not built
    assert d.first()["is_built"] is None and d.first()["promoted"]
    reg.append("version_events", rows)
    d, rows = vs.rollback(reg.read("version_events"), "v1", at=6)
    assert d.first()["from_version"] == "v7"
    reg.append("version_events", rows)
    assert reg.active_version() == "v1"
    assert [r["kind"] for r in reg.read("version_events").orderBy("event_seq").collect()] == ["promote", "rollback"]


def test_registry_docs_and_missing_version(spark, tmp_path):
    reg = Registry(spark, str(tmp_path / "r3"))
    reg.upsert_docs(spark.createDataFrame(DOCS[:2], "doc_id bigint, title string, body string"), now=1)
    reg.upsert_docs(spark.createDataFrame([(1, "t", "new body")], "doc_id bigint, title string, body string"), now=2)
    d = {r["doc_id"]: r for r in reg.docs().collect()}
    assert d[1]["body"] == "new body" and d[1]["updated_at"] == 2 and len(d) == 2
    try:
        reg.read_vectors("v9")
        raise AssertionError("expected a missing-version error")
    except FileNotFoundError:
        pass
    try:
        reg.golden()
        raise AssertionError("expected an empty-golden error")
    except RuntimeError:
        pass


def test_last_write_wins_whatever_the_clock_says(spark, tmp_path):
    reg = Registry(spark, str(tmp_path / "registry"))
    ddl = "doc_id bigint, title string, body string"
    for body, now in (("one", 5), ("zwei", 5), ("three", 4)):
        reg.upsert_docs(spark.createDataFrame([(1, "t", body)], ddl), now=now)
    assert [r["body"] for r in reg.docs().collect()] == ["three"]
    reg.upsert_docs(spark.createDataFrame([(1, "t", "a"), (1, "t", "c"), (1, "t", "b"), (2, None, None)], ddl), now=4)
    assert {r["doc_id"]: r["body"] for r in reg.docs().collect()} == {1: "c", 2: None}


def test_rebuild_has_its_own_folder_and_digit_versions_stay_text(spark, tmp_path):
    reg = Registry(spark, str(tmp_path / "registry"))
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id bigint, text string")
    first = reg.write_vectors(em.embed_text(docs, {"007": 8, "v2": 4}), 10)
    assert {(r["version"], r["doc_count"]) for r in first.collect()} == {("007", 2), ("v2", 2)}
    old = reg.read_vectors("007")
    reg.write_vectors(em.embed_text(docs.where("doc_id = 1"), {"007": 8}), 10)  # same stamp: the later counts
    assert reg.read_vectors("007").count() == 1 and reg.read_vectors("v2").count() == 2
    assert old.count() == 2  # a reader of the earlier build is not disturbed
    assert {r["version"] for r in reg.read_vectors("007").collect()} == {"007"}


def test_builds_latest_writes_what_it_counts(spark, monkeypatch):
    sf, made = "/root/testdata/sf0.001", []
    monkeypatch.setattr(catalog, "Registry", lambda *a: made.append(Registry(*a)) or made[-1])
    rows = {r["version"]: r for r in catalog.QUERIES["builds_latest"](spark, sf).collect()}
    assert len(made) == 1 and rows["v1"]["built_at"] == 200
    for version, row in rows.items():
        assert made[0].read_vectors(version).count() == row["doc_count"]

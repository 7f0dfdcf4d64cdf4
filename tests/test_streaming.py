from perfkit.operators.stage_metrics import profile_stages
from perfkit.sources import eventlog as ev
from perfkit.streaming import eventlog_stream as es
from tests.test_eventlog import stage, start, task


def test_stream_ingest_matches_batch(spark, tmp_path):
    src = tmp_path / "incoming" / "app-1"
    src.mkdir(parents=True)
    (src / "part1").write_text("\n".join([start("app-1", "n", 1), stage(1, n=12)] +
                                         [task(tid=i, launch=0, finish=10 * (i + 1)) for i in range(6)]))
    table, ck = str(tmp_path / "rows"), str(tmp_path / "ck")
    es.ingest(spark, str(tmp_path / "incoming"), table, ck, rolled=True)
    (src / "part2").write_text("\n".join(task(tid=10 + i, launch=0, finish=500) for i in range(6)))
    es.ingest(spark, str(tmp_path / "incoming"), table, ck, rolled=True)   # only the new file
    m, _ = es.profile_rows(spark, table)
    b, _ = profile_stages(ev.parse_events(ev.read_eventlog(spark, str(tmp_path / "incoming"), rolled=True)),
                          materialize=False)
    cols = [c for c in m.columns if c != "log_id"]
    assert m.count() == 1 and m.select(cols).exceptAll(b.select(cols)).count() == 0
    assert m.first()["task_max_ms"] == 500

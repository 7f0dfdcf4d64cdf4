"""Plan nodes leave a worker in bounded batches."""

import json

import pyarrow as pa

from perfkit.sources import sqlplans as sq


def test_plan_nodes_come_in_bounded_batches(spark, monkeypatch):
    monkeypatch.setattr(sq, "HELD_NODES", 8)
    seen = []
    monkeypatch.setattr(sq, "latest_plans", lambda lines: lines)

    class Plans:
        def mapInArrow(self, run, schema):
            scan = {"nodeName": "Scan", "simpleString": "s", "metrics": [{"name": "m", "accumulatorId": 1}], "children": []}
            plan = json.dumps({"nodeName": "Union", "children": [scan] * 4})
            batch = pa.RecordBatch.from_arrays([pa.array(["a"] * 9), pa.array(range(9)), pa.array([plan] * 8 + ["{"])],
                                               names=["log_id", "execution_id", "plan"])
            seen.extend(run(iter([batch, batch])))

    sq.plan_nodes(Plans())
    assert all(b.num_rows <= 8 for b in seen) and sum(b.num_rows for b in seen) == 2 * 8 * 5
    rows = [r for b in seen for r in b.to_pylist()]
    assert [r["node_id"] for r in rows[:5]] == [0, 1, 2, 3, 4] and rows[1]["metrics"] == [{"name": "m", "accumulator_id": 1}]

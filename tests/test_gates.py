"""Gates over a stream: targets, deadlines, repeats, and a restart from the checkpoint."""

from datetime import datetime, timedelta

import pandas as pd
import pytest
from lodestack.session import ship
from lodestack.streaming import gates, status

SCHEMA = "app string, record string, ts timestamp"
START = datetime(2024, 1, 1)


@pytest.fixture
def run(spark, tmp_path):
    ship(spark)

    def go(rows, target=3, limit="10 days"):
        """Adds a file of rows (key, record, day) to the folder, starts a new query on the same checkpoint, returns all outcomes."""
        made = [(k, r, None if d is None else START + timedelta(days=d)) for k, r, d in rows]
        spark.createDataFrame(made, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = gates.gated(status.read_stream(spark, str(tmp_path / "in"), SCHEMA, "*.parquet"), "app", "record", "ts", target, limit)
        out = gates.run_to_files(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        return sorted((r.key, r.outcome, r.records, r.waited_s // 86400) for r in out.collect())

    return go


def test_targets_deadlines_and_a_restart(run):
    first = run([("a", "1", 0), ("a", "2", 1), ("a", "2", 1), ("b", "1", 0), ("b", "2", 2), ("b", "3", 3), ("b", "4", 4), ("c", "1", 0), ("c", "2", 11), ("c", "3", 1), (None, "1", 0), ("d", None, 0), ("e", "1", None)])
    assert first == [("a", "given_up", 2, 10), ("b", "started", 3, 3), ("c", "given_up", 2, 10)]
    second = run([("f", "1", 12), ("f", "2", 13), ("b", "5", 12), ("a", "3", 12), ("g", "1", 13)])
    assert second == first
    third = run([("f", "2", 13), ("f", "3", 14), ("h", "1", 40)])
    assert third == sorted([*first, ("f", "started", 3, 2), ("g", "given_up", 1, 10)])
    assert run([("f", "9", 41), ("b", "9", 41)]) == third


def test_nothing_new_decides_nothing(run):
    rows = [("a", str(k), 0) for k in range(5)]
    assert run(rows) == [("a", "started", 3, 0)] == run(rows)


def test_state_is_read_and_written_once_a_batch():
    """However many records a key brings; each access is a message to the store."""
    calls, kept = [], {}

    class Value:
        def __init__(self, name):
            self.name = name

        def exists(self):
            calls.append("exists")
            return self.name in kept

        def get(self):
            calls.append("get")
            return kept.get(self.name)

        def update(self, value):
            calls.append("update")
            kept[self.name] = value

        def containsKey(self, key):
            calls.append("has")
            return False

        def updateValue(self, key, value):
            calls.append("put")

    class Handle:
        def getValueState(self, name, schema):
            return Value(name)

        getMapState = getValueState

        def registerTimer(self, at):
            calls.append(("timer", at))

    gate = gates.Gate(300, 1000)
    gate.init(Handle())
    batch = lambda a, b: iter([pd.DataFrame({"ms": [5] * (b - a), "id": [str(k) for k in range(a, b)]})])
    assert list(gate.handleInputRows(("k",), batch(0, 250), None)) == []
    assert calls == ["get", "update", ("timer", 1005)]
    calls.clear()
    (out,) = gate.handleInputRows(("k",), batch(200, 400), None)
    assert out.values.tolist() == [["k", "started", 300, 0]] and calls == ["get", "update"]

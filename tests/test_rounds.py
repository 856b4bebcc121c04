"""Readiness with rounds, time to live, and a mapping that changes."""

import json
import time

import pytest
from conftest import rows
from pyspark.sql import Row
from pyspark.sql import functions as F

from millrace.streaming import readiness as rd
from millrace.streaming.rounds import PROVIDER, ReadinessLoop, _Rounds, readiness_rounds

KIND = "batch_id string, finish_event string, dataset string, status string, at timestamp, id long"
MAPPING = {"ab": ("a", "b"), "b": ("b",), "ca": ("c", "a")}


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, PROVIDER)
    yield spark
    spark.conf.set(key, before)


class Inbox:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.n = spark, folder, 0
        folder.mkdir()

    def put(self, *messages):
        """Messages as (batch id, event, status)."""
        self.n += 1
        lines = [
            json.dumps({"batch_id": b, "finish_event": e, "dataset": e, "status": s, "id": 100 * self.n + i,
                        "at": f"2024-01-01T00:{self.n:02d}:{i:02d}Z"})
            for i, (b, e, s) in enumerate(messages)
        ]
        (self.folder / f"{self.n}.json").write_text("\n".join(lines) + "\n")

    def stream(self):
        return self.spark.readStream.schema(KIND).json(str(self.folder))

    def batch(self):
        return self.spark.read.schema(KIND).json(str(self.folder))


def test_rounds_fire_like_the_batch_and_then_begin_anew(rocks, tmp_path):
    inbox = Inbox(rocks, tmp_path / "in")

    def run(ttl=None, name="x"):
        rd.run_available(readiness_rounds(inbox.stream(), MAPPING, ttl), str(tmp_path / f"c-{name}"), str(tmp_path / f"out-{name}"))
        return rocks.read.parquet(str(tmp_path / f"out-{name}"))

    inbox.put(("1", "a", "SUCCESS"), ("2", "b", "FAILED"), ("1", "b", "RUNNING"), (None, "b", "SUCCESS"))
    assert rows(run()) == [(None, 0, "b")]
    inbox.put(("1", "b", "COMPLETED"), ("2", "b", "SUCCESS"), ("2", "zz", "SUCCESS"))
    got = run()
    assert rows(got.drop("round")) == rows(rd.ready_targets(inbox.batch(), rd.mapping_rows(rocks, MAPPING)))
    assert rows(got.filter("batch_id = '1'")) == [("1", 0, "ab"), ("1", 0, "b")]
    inbox.put(("1", "c", "SUCCESS"))  # the last target of this round
    assert rows(run().filter("batch_id = '1'")) == [("1", 0, "ab"), ("1", 0, "b"), ("1", 0, "ca")]
    state = rocks.read.format("statestore").option("path", str(tmp_path / "c-x")).option("stateVarName", "seen").load()
    assert rows(state.select("key.batch_id").distinct()) == [(None,), ("2",)]
    inbox.put(("1", "b", "SUCCESS"))  # the next round
    assert rows(run().filter("round = 1")) == [("1", 1, "b")]


def test_state_expires(rocks, tmp_path):
    inbox = Inbox(rocks, tmp_path / "in")

    def run():
        rd.run_available(readiness_rounds(inbox.stream(), MAPPING, 1000), str(tmp_path / "c"), str(tmp_path / "out"))
        return rows(rocks.read.schema("batch_id string, round long, target string").parquet(str(tmp_path / "out")).select("batch_id", "target"))

    inbox.put(("1", "a", "SUCCESS"))
    assert run() == []
    time.sleep(2.5)
    inbox.put(("1", "b", "SUCCESS"), ("2", "a", "SUCCESS"), ("2", "b", "SUCCESS"))
    assert run() == [("1", "b"), ("2", "ab"), ("2", "b")]  # a of batch 1 has been forgotten


class Counted:
    """States of one key without a stream; counts the calls, each of which is a round trip."""

    def __init__(self):
        self.calls, self.now = 0, 0

    def getValueState(self, name, *_):
        handle = self

        class Value:
            held = None

            def get(self):
                handle.calls += 1
                return self.held

            def update(self, value):
                handle.calls += 1
                self.held = value

            def clear(self):
                self.update(None)

        return Value()

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_calls_to_the_state_do_not_grow_with_the_events():
    needs = {f"t{k}": (f"e{k}",) for k in range(40)} | {"never": ("x",)}
    handle, rounds = Counted(), _Rounds(needs, None)
    rounds.init(handle)
    batch = [Row(finish_event=f"e{k}", status="SUCCESS", at=None, id=k) for k in range(40)]
    assert len(list(rounds.handleInputRows(("1",), iter(batch), handle))) == 40
    assert handle.calls <= 3
    assert list(rounds.handleInputRows(("1",), iter(batch), handle)) == []
    assert handle.calls <= 5


def test_each_event_expires_by_itself():
    handle, rounds = Counted(), _Rounds({"ab": ("a", "b"), "abc": ("a", "b", "c")}, 1000)
    rounds.init(handle)

    def put(now, event):
        handle.now = now
        made = rounds.handleInputRows(("1",), iter([Row(finish_event=event, status="SUCCESS", at=None, id=1)]), handle)
        return [r.target for r in made]

    assert put(0, "a") == put(800, "c") == put(1500, "b") == []  # a is forgotten by then
    assert put(1600, "a") == ["ab", "abc"]


def test_a_target_added_between_triggers_fires(spark, tmp_path):
    inbox = Inbox(spark, tmp_path / "in")
    mapping = tmp_path / "mapping.json"
    mapping.write_text(json.dumps({"a,b": "ab"}))

    def loop(checkpoint="c"):
        made = ReadinessLoop(spark, str(tmp_path / "loop"), str(mapping), buckets=4)
        made.follow(inbox.stream(), str(tmp_path / checkpoint))
        fired = made.fired.read()
        return [] if fired is None else rows(fired.select("batch_id", "target"))

    inbox.put(("1", "a", "SUCCESS"), ("1", "b", "FAILED"), ("2", "b", "SUCCESS"), (None, "a", "SUCCESS"), (None, "b", "SUCCESS"))
    assert loop() == [(None, "ab")]
    inbox.put(("1", "b", "SUCCESS"))
    assert loop() == [(None, "ab"), ("1", "ab")]
    mapping.write_text(json.dumps({"a,b": "ab", "b": "alone"}))
    inbox.put(("3", "c", "SUCCESS"))
    want = [(None, "ab"), (None, "alone"), ("1", "ab"), ("1", "alone"), ("2", "alone")]
    assert loop() == want
    assert rows(ReadinessLoop(spark, str(tmp_path / "loop"), str(mapping)).statuses.read().select("finish_event").distinct()) == [("a",), ("b",), ("c",)]
    inbox.put(("1", "b", "SUCCESS"), ("1", "a", "FAILED"), ("2", "a", "SUCCESS"))
    assert sorted(loop(), key=str) == sorted([*want, ("2", "ab")], key=str)


def test_a_repeated_trigger_adds_nothing(spark, tmp_path):
    mapping = tmp_path / "mapping.json"
    mapping.write_text(json.dumps({"a": "a"}))
    loop = ReadinessLoop(spark, str(tmp_path / "loop"), str(mapping), buckets=2)
    batch = spark.createDataFrame([("1", "a", "d", "SUCCESS", None, 1)], KIND)
    for _ in range(2):
        loop.trigger(batch, 0)
        assert rows(loop.fired.read()) == [("1", "a", 0)]
    loop.trigger(batch, 1)
    loop.trigger(batch.limit(0), 2)
    assert rows(loop.fired.read()) == [("1", "a", 0)]
    assert loop.statuses.read().select(F.count("*")).first()[0] == 1

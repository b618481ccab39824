"""Events that can't be decoded are set aside, replayed, and never lost or doubled."""

import pytest
from pyspark.sql import functions as F

from radpref.sources.events import from_rows
from radpref.sources.quarantine import Quarantine

ROWS = [
    {"request_id": "a", "input_payload_json": '{"x": 1}'},
    {"request_id": "b", "input_payload_json": "?{}"},
    {"request_id": "c", "input_payload_json": "[1]"},
    {"request_id": "d", "input_payload_json": "{}", "issues_json": "[1"},
    {"request_id": "e", "input_payload_json": None},
    {"request_id": " ", "input_payload_json": "{}"},
    {"request_id": "g", "input_payload_json": '"{\\"x\\": 2}"'},
    {"request_id": "b", "input_payload_json": "?{}"},
]


def strip_mark(events):
    return events.withColumn("input_payload_json", F.regexp_replace("input_payload_json", r"^\?", ""))


def held(store):
    good = sorted((r["request_id"], r["tries"]) for r in store.good().collect())
    waiting = sorted((r["request_id"], r["fault"], r["tries"]) for r in store.waiting().collect())
    return good, waiting


def test_rows_in_are_rows_kept(spark, tmp_path):
    store = Quarantine(spark, str(tmp_path / "q"))
    assert held(store) == ([], [])
    assert store.take_in(from_rows(spark, ROWS)) == 1
    bad = [(" ", "no request_id"), ("b", "payload is not JSON"), ("b", "payload is not JSON"), ("c", "payload is not an object"), ("d", "issues are not JSON")]
    assert held(store) == ([("a", 0), ("e", 0), ("g", 0)], [(*x, 0) for x in bad])
    assert store.replay(strip_mark) == 2
    good, waiting = held(store)
    assert good == [("a", 0), ("b", 1), ("b", 1), ("e", 0), ("g", 0)] and [w[0] for w in waiting] == [" ", "c", "d"] and {w[2] for w in waiting} == {1}
    # a later intake waits beside what the replay left, and the next replay takes both
    store.take_in(from_rows(spark, ROWS[1:2]))
    assert sorted(w[0] for w in held(store)[1]) == [" ", "b", "c", "d"]
    store.replay(strip_mark)
    good, waiting = held(store)
    assert sorted(g[0] for g in good) == ["a", "b", "b", "b", "e", "g"] and len(good) + len(waiting) == len(ROWS) + 1
    assert {w[0]: w[2] for w in waiting} == {" ": 2, "c": 2, "d": 2}


def test_empty_intake_and_replay_of_nothing(spark, tmp_path):
    store = Quarantine(spark, str(tmp_path / "q"))
    store.replay(strip_mark)
    store.take_in(from_rows(spark, ROWS).where("false"))
    assert held(store) == ([], [])


def test_a_key_counts_once(spark, tmp_path):
    store = Quarantine(spark, str(tmp_path / "q"))
    first = store.take_in(from_rows(spark, ROWS), key="batch7")
    assert store.take_in(from_rows(spark, ROWS), key="batch7") == first
    # an attempt that began before the other one was entered
    attempt = "in-0-batch7"
    store._write(from_rows(spark, ROWS).withColumn("tries", F.lit(0)), attempt)
    assert store.ledger.enter("rounds", 2, attempt)
    assert sum(map(len, held(store))) == len(ROWS)


def test_failed_rounds_leave_nothing(spark, tmp_path, monkeypatch):
    store = Quarantine(spark, str(tmp_path / "q"))
    store.take_in(from_rows(spark, ROWS))
    before = held(store)
    with monkeypatch.context() as m:
        m.setattr(store.ledger, "enter", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        for run in (lambda: store.take_in(from_rows(spark, ROWS)), lambda: store.replay(strip_mark)):
            with pytest.raises(OSError):
                run()
    assert held(store) == before
    with pytest.raises(ValueError):
        store.replay(lambda e: e.where("request_id <> 'c'"))
    assert held(store) == before


def test_an_intake_during_a_replay_is_not_lost(spark, tmp_path):
    store = Quarantine(spark, str(tmp_path / "q"))
    store.take_in(from_rows(spark, ROWS))
    others = [from_rows(spark, [{"request_id": "late", "input_payload_json": "?{}"}])]

    def meanwhile(events):
        while others:
            Quarantine(spark, store.path).take_in(others.pop())
        return strip_mark(events)

    assert store.replay(meanwhile) == 3
    good, waiting = held(store)
    assert ("late", 1) in good and len(good) + len(waiting) == len(ROWS) + 1

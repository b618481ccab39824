"""Answers are kept: what a killed run got is not asked again, failures are, and shared prompts are asked once."""

import functools
import os

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from radpref.operators.answers import answers_to, ask_missing, read_answers

ASKED = "request_id string, judge_prompt string"


def client(log, mode):
    """Notes each call in a file of its own; ``mode``: a file with the prompt that kills the worker, or that fails."""

    def make():
        def call(prompt):
            fd = os.open(log, os.O_APPEND | os.O_CREAT | os.O_WRONLY)
            os.write(fd, f"{prompt}\n".encode())
            os.close(fd)
            how, _, what = open(mode).read().partition(" ")
            if prompt == what and how == "kill":
                os._exit(1)
            if prompt == what and how == "fail":
                raise RuntimeError("busy")
            return {"answer": f"to {prompt}", "prompt_tokens": 1, "completion_tokens": 2, "total_tokens": 3}

        return call

    return make


@pytest.fixture
def judge(tmp_path):
    mode, log = tmp_path / "mode", tmp_path / "log"
    mode.write_text("")
    log.write_text("")

    def calls():
        out = log.read_text().split()
        log.write_text("")
        return sorted(out)

    return functools.partial(client, str(log), str(mode))(), mode, calls


def test_a_killed_run_goes_on(spark, tmp_path, judge):
    make, mode, calls = judge
    path = str(tmp_path / "answers")
    asked = spark.createDataFrame([(f"r{i}", f"p{i}") for i in range(40)], ASKED)
    mode.write_text("kill p11")
    with pytest.raises((PySparkException, Py4JJavaError)):
        ask_missing(asked, path, make, per_task=3, concurrency=1, wait=0)
    calls()
    kept = {r["answer"] for r in read_answers(spark, path).collect()}
    assert 0 < len(kept) < 40
    mode.write_text("")
    assert ask_missing(asked, path, make, per_task=3, concurrency=2, wait=0) == 40 - len(kept)
    assert calls() == sorted(f"p{i}" for i in range(40) if f"to p{i}" not in kept)
    assert sorted((r["request_id"], r["answer"]) for r in answers_to(asked, path).collect()) == sorted((f"r{i}", f"to p{i}") for i in range(40))
    assert ask_missing(asked, path, make) == 0 and calls() == []


def test_failures_are_stored_and_asked_again(spark, tmp_path, judge):
    make, mode, calls = judge
    path = str(tmp_path / "answers")
    asked = spark.createDataFrame([("a", "p"), ("b", "p"), ("c", "q"), ("d", None), (None, "q")], ASKED)
    mode.write_text("fail p")
    assert ask_missing(asked, path, make, attempts=3, wait=0.01) == 2
    assert calls() == ["p", "p", "p", "q"]
    assert [(r["answer"], r["judge_error"]) for r in read_answers(spark, path).orderBy("answer").collect()] == [(None, "RuntimeError: busy"), ("to q", None)]
    mode.write_text("")
    assert ask_missing(asked, path, make) == 1 and calls() == ["p"]
    good = answers_to(asked, path).where("answer is not null").collect()
    assert sorted((r["request_id"] or "", r["answer"]) for r in good) == [("", "to q"), ("a", "to p"), ("b", "to p"), ("c", "to q")]


def test_nothing_to_ask(spark, tmp_path, judge):
    make, _, calls = judge
    asked = spark.createDataFrame([], ASKED)
    assert ask_missing(asked, str(tmp_path / "answers"), make) == 0 and calls() == []
    assert answers_to(asked, str(tmp_path / "answers")).count() == 0

"""A table of judge answers that only grows: what it holds is not asked again."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from radpref.operators.judge import ask_judge
from radpref.shared import shared_dir
from radpref.sources.events import available

STORED = "prompt_id string, answer string, prompt_tokens long, completion_tokens long, total_tokens long, judge_error string, answered_at timestamp"


def _numbered(asked: DataFrame) -> DataFrame:
    return asked.withColumn("prompt_id", F.sha2("judge_prompt", 256))


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """All stored answers and failures, several to a prompt if it was tried in several runs."""
    return spark.read.schema(STORED).parquet(path) if available(spark, path) else spark.createDataFrame([], STORED)


def ask_missing(asked: DataFrame, path: str, client: Callable[[], Callable[[str], dict]], per_task: int = 200, concurrency: int = 4, attempts: int = 4, wait: float = 1.0) -> int:
    """Asks all prompts of ``asked`` (``request_id, judge_prompt``) that have no answer at ``path``, and appends the answers; returns how many were asked.

    A prompt that several requests share is asked once. A failure is stored too, and asked again in the next run. Each
    task asks ``per_task`` prompts, ``concurrency`` at a time, and its answers are there once it has ended, whatever becomes of
    the others: a run that is killed and started again asks twice only what its running tasks had not yet put down. Null prompts are not asked.
    """
    spark = asked.sparkSession
    pending = shared_dir(spark, "prompts")
    answered = read_answers(spark, path).where("answer is not null").select("prompt_id")
    prompts = _numbered(asked.where("judge_prompt is not null")).groupBy("prompt_id").agg(F.first("judge_prompt").alias("judge_prompt"))
    prompts.join(answered, "prompt_id", "left_anti").write.parquet(pending)
    # the prompts as they were put down: worked out again, others could have been answered in between
    todo = spark.read.schema("prompt_id string, judge_prompt string").parquet(pending)
    count = todo.count()
    if not count:
        return 0
    dealt = todo.repartition(math.ceil(count / per_task), "prompt_id").withColumnRenamed("prompt_id", "request_id")
    answers = ask_judge(dealt, client, attempts, concurrency, wait).withColumnRenamed("request_id", "prompt_id")
    # each task's file is part of the table when the task ends, not when the job does
    answers.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(path)
    return count


def answers_to(asked: DataFrame, path: str) -> DataFrame:
    """The stored answers to ``asked``, a row a request and answer, for :func:`~radpref.plans.curate.curate`."""
    return _numbered(asked).select("request_id", "prompt_id").join(read_answers(asked.sparkSession, path), "prompt_id").drop("prompt_id")

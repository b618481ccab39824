"""Events that can't be decoded, set aside with the reason, and taken up again once they can be mended."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from radpref.functions import variants as V
from radpref.functions.text import blank
from radpref.schemas import EVENT, to_events
from radpref.sources.events import available
from radpref.sources.output import COMMIT, Ledger

_ROUNDS = "rounds"
_STORED = T.StructType([*[T.StructField(f.name, f.dataType) for f in EVENT], T.StructField("fault", T.StringType()), T.StructField("tries", T.IntegerType()), T.StructField(COMMIT, T.StringType()), T.StructField("place", T.StringType())])


def event_fault() -> Column:
    """Why an event can't be decoded, the first reason that holds; null if it can. A payload that is missing or blank is no fault."""
    payload, issues = V.parse(F.col("input_payload_json")), V.parse(F.col("issues_json"))
    return (
        F.when(blank(F.col("request_id")), "no request_id")
        .when(payload.isNull() & ~blank(F.col("input_payload_json")), "payload is not JSON")
        .when(F.coalesce(~V.kind(payload).like("OBJECT%"), F.lit(False)), "payload is not an object")
        .when(issues.isNull() & ~blank(F.col("issues_json")), "issues are not JSON")
    )


class Quarantine:
    """A store of events in which those that can't be decoded stand apart.

    Each intake and each replay is a round, written in one pass under the name of its attempt, good and bad events in
    different folders. The round counts from when the ledger names the attempt, so a run that fails at whatever point
    leaves nothing that is seen, and rows are neither lost nor doubled: what was taken in is good or waiting, always.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.ledger = Ledger(spark, self.path)

    def take_in(self, events: DataFrame, key: str | None = None) -> int:
        """A round of new events; its number. Of rounds with one ``key`` (letters and digits, say a batch's) only the first counts."""
        if key is not None:
            done = self._rounds().where(F.col("key") == key).agg(F.min("round")).first()[0]
            if done is not None:
                return done
        attempt = f"in-{uuid.uuid4().hex}-{key or ''}"
        self._write(to_events(events).withColumn("tries", F.lit(0)), attempt)
        number = self._last() + 1
        while not self.ledger.enter(_ROUNDS, number, attempt):
            number += 1
        return number

    def replay(self, mend: Callable[[DataFrame], DataFrame]) -> int:
        """Tries all waiting events again after ``mend``, which gives a row for each row; the round's number.

        Those that still can't be decoded wait on, with their new reason. If another round came in between, its events are
        read as well and the attempt is made again.
        """
        while True:
            last = self._last()
            attempt = f"re-{uuid.uuid4().hex}-"
            before, after = Observation(), Observation()
            waiting = self._waiting(last).observe(before, F.count(F.lit(1)).alias("n"))
            mended = mend(waiting.drop("fault")).select(*EVENT.names, (F.col("tries") + 1).alias("tries"))
            self._write(mended.observe(after, F.count(F.lit(1)).alias("n")), attempt)
            if before.get["n"] != after.get["n"]:
                raise ValueError(f"mend made {after.get['n']} rows of {before.get['n']}")
            if self.ledger.enter(_ROUNDS, last + 1, attempt):
                return last + 1

    def good(self) -> DataFrame:
        """All events that can be decoded, with ``tries``, the number of replays that each took."""
        return self._counted().where("place = 'good'").select(*EVENT.names, "tries")

    def waiting(self) -> DataFrame:
        """All events set aside that no replay has mended, with ``fault`` and ``tries``."""
        return self._waiting(None)

    def _write(self, events: DataFrame, attempt: str) -> None:
        rows = events.withColumn("fault", event_fault()).withColumn("place", F.when(F.col("fault").isNull(), "good").otherwise("aside"))
        rows.withColumn(COMMIT, F.lit(attempt)).write.mode("append").partitionBy(COMMIT, "place").parquet(self.path)

    def _rounds(self) -> DataFrame:
        """``round, attempt, kind, key`` of the rounds that count."""
        all_rounds = self.ledger.entries().where(F.col("stream") == _ROUNDS).select(F.col("batch").alias("round"), "attempt", F.split_part("attempt", F.lit("-"), F.lit(1)).alias("kind"), F.nullif(F.split_part("attempt", F.lit("-"), F.lit(3)), F.lit("")).alias("key"))
        nth = F.row_number().over(Window.partitionBy(F.coalesce("key", "attempt")).orderBy("round"))
        return all_rounds.withColumn("nth", nth).where("nth = 1").drop("nth")

    def _last(self) -> int:
        return self.ledger.entries().where(F.col("stream") == _ROUNDS).agg(F.coalesce(F.max("batch"), F.lit(0).cast("long"))).first()[0]

    def _counted(self) -> DataFrame:
        if not available(self.spark, self.path):
            return self.spark.createDataFrame([], T.StructType([*_STORED, T.StructField("round", T.LongType())]))
        stored = self.spark.read.schema(_STORED).parquet(self.path)
        return stored.join(self._rounds().select("round", F.col("attempt").alias(COMMIT)), COMMIT)

    def _waiting(self, last: int | None) -> DataFrame:
        rounds = self._rounds() if last is None else self._rounds().where(F.col("round") <= last)
        since = rounds.where("kind = 're'").agg(F.coalesce(F.max("round"), F.lit(0).cast("long"))).first()[0]
        upto = F.lit(True) if last is None else F.col("round") <= last
        return self._counted().where((F.col("place") == "aside") & (F.col("round") >= since) & upto).select(*EVENT.names, "fault", "tries")

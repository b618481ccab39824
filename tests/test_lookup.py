"""Many requests by key: fewer row groups are read than the file has, and each request is there once."""

import hashlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from radpref.sources.events import fetch_many, matching
from radpref.sources.output import append_output, keyed_writer, read_output


def key(i):
    return hashlib.md5(str(i).encode()).hexdigest()


def scanned(df):
    """Rows that the scan gave out while ``df`` was collected, and the rows of the result."""
    rows = df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value(), rows


def test_row_groups_without_the_keys_are_skipped(spark, tmp_path):
    path = str(tmp_path / "events")
    rows = spark.range(60_000, numPartitions=1).select(F.md5(F.col("id").cast("string")).alias("request_id"), F.col("id").alias("n"), F.repeat(F.sha2(F.col("id").cast("string"), 512), 4).alias("final_impression"))
    reads = []
    for writer in (rows.write, keyed_writer(rows)):
        # without dictionaries, which would tell groups apart as well
        writer.option("parquet.block.size", 1 << 20).option("parquet.enable.dictionary", "false").mode("overwrite").parquet(path)
        groups = [pq.ParquetFile(f).metadata.num_row_groups for f in map(str, tmp_path.glob("events/*.parquet"))]
        assert len(groups) == 1 and groups[0] >= 6
        keys = spark.createDataFrame([(key(i),) for i in (5, 100, 200)] + [("none",), (None,)], "request_id string")
        read, found = scanned(matching(spark.read.parquet(path), keys))
        assert sorted(r["n"] for r in found) == [5, 100, 200]
        reads.append(read)
    assert reads[1] <= 60_000 * 3 / groups[0] and reads[1] < reads[0]
    many = spark.range(59_000, 59_400).select(F.md5(F.col("id").cast("string")).alias("request_id"))
    assert sorted(r["n"] for r in matching(spark.read.parquet(path), many).collect()) == list(range(59_000, 59_400))


@pytest.mark.parametrize("few", [0, 100])
def test_one_row_a_request(spark, few):
    events = spark.createDataFrame([("a", "1", "old"), ("a", "2", "new"), ("a", None, "never"), ("b", None, "only"), (None, "3", "x")], "request_id string, timestamp string, decision string")
    keys = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "request_id string")
    assert sorted((r["request_id"], r["decision"]) for r in fetch_many(events, keys, few).collect()) == [("a", "new"), ("b", "only")]
    assert len(fetch_many(events.drop("timestamp"), keys, few).collect()) == 2
    assert fetch_many(events, keys.where("false"), few).count() == 0


def test_the_output_table_has_bloom_filters(spark, tmp_path):
    path = str(tmp_path / "out")
    append_output(spark.range(3000, numPartitions=1).select(F.md5(F.col("id").cast("string")).alias("request_id"), F.current_timestamp().alias("created_at"), *[F.lit("x").alias(c) for c in ("tenant_id", "body_part", "disposition")], F.lit(True).alias("is_dpo_training_ready")), path)
    missing, _ = scanned(matching(spark.read.parquet(path), spark.createDataFrame([("7" * 32,)], "request_id string")))
    assert missing == 0 and read_output(spark, path).count() == 3000

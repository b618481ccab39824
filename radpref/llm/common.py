"""Small helpers that the training-data operators share.

Rows that an operator uses twice are written once to the folder named by ``spark.checkpoint.dir``
(shared by the driver and all executors), so a lost executor never costs more than its own tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from radpref.shared import shared_dir

#: White space that ends a word: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]+"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, lineage cut."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")  # shuffle files go once it is written
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete the files behind a frame that :func:`cut` made and nothing reads any more."""
    spark = df.sparkSession
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(hadoop).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts within a few MB, however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about so many bytes of text; a longer text is a part of its own."""
    start = have = 0
    for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        if i > start and have + (n or 0) > size:
            yield batch.slice(start, i - start)
            start, have = i, 0
        have += n or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def free_name(name: str, columns: list[str]) -> str:
    """A column name that none of ``columns`` has, in any case of letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_rows(docs: DataFrame, row: str, name: str) -> DataFrame:
    """``docs`` with a number of each row's own: its ``doc_id`` if all rows have one and none is repeated, else numbers that are
    written down with the rows, so that a task run again doesn't number them otherwise."""
    ids = docs.select(F.col("doc_id").cast("long").alias("id"))
    if ids.groupBy("id").count().where("count > 1 or id is null").isEmpty():
        return docs.withColumn(row, F.col("doc_id").cast("long"))
    return cut(docs.withColumn(row, F.monotonically_increasing_id()), name)


def numbered(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """``df`` with numbers from 0 by an order, without sorting it in one task.

    Rows are dealt out by ranges and numbered within them; where a range begins is a row a task.
    """
    part = free_name("number_part", df.columns)
    dealt = cut(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "numbered")
    count = dict(dealt.groupBy(part).count().collect())
    before, starts = 0, []
    for k in sorted(count):
        starts.append((k, before))
        before += count[k]
    first = free_name("number_first", df.columns)
    known = df.sparkSession.createDataFrame(starts, f"{part} int, {first} long")
    within = F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1
    return dealt.withColumn(name, within).join(F.broadcast(known), part).withColumn(name, (F.col(name) + F.col(first)).cast("long")).drop(part, first)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id's decimal text, modulo ``folds``, is ``fold``; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(True))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def thinned(df: DataFrame, want: int, seed: int, *key: str) -> DataFrame:
    """About twice ``want`` rows, or all if there are no more, by a hash of the key.

    Picking ``want`` of these by an order costs each task, and whoever merges the tasks, no more than that,
    however many rows and tasks there are.
    """
    n = df.count()
    share = min(1.0, (2 * want + 100) / n) if n else 1.0
    return df.where(F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1 << 40)) < int(share * (1 << 40))) if share < 1 else df

"""Sources of review events: tables and files, one request by key, a single event in hand, a JSON file."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from radpref.functions import variants as V
from radpref.schemas import EVENT, EVENT_COLUMNS, to_events


def read_events(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """All events at a path. Only the event columns are read; large others (embeddings) never leave the files."""
    return to_events(spark.read.format(fmt).options(**options).load(path))


def fetch(events: DataFrame, request_id: str) -> DataFrame:
    """One event by key: at most one row. The comparison is pushed into the scan.

    Of several rows of the request the one with the latest ``timestamp`` is taken, if there is such a
    column, else any.
    """
    found = events.where(F.col("request_id") == request_id)
    if "timestamp" in events.columns:
        found = found.orderBy(F.desc_nulls_last("timestamp"))
    return to_events(found.limit(1))


def fetch_many(events: DataFrame, keys: DataFrame, few: int = 200) -> DataFrame:
    """The events of all requests in ``keys`` (a frame with ``request_id``), at most one row a request, chosen as :func:`fetch` does.

    Up to ``few`` keys become comparisons that the scan tests against each row group's statistics, dictionary and Bloom
    filter (:func:`~radpref.sources.output.keyed_writer` writes one); more of them are joined. Null keys find nothing.
    """
    found = matching(events, keys, few)
    row = F.struct(*[c for c in events.columns if c in EVENT_COLUMNS])
    # a row without a time counts less than any other, but is not lost
    one = F.max_by(row, F.struct(F.col("timestamp").isNotNull(), "timestamp")) if "timestamp" in events.columns else F.first(row)
    return to_events(found.groupBy("request_id").agg(one.alias("e")).select("e.*"))


def matching(rows: DataFrame, keys: DataFrame, few: int = 200) -> DataFrame:
    """All rows whose ``request_id`` is among the keys."""
    wanted = keys.select("request_id").where("request_id is not null").distinct()
    first = [r[0] for r in wanted.limit(few + 1).collect()]
    if len(first) > few:
        return rows.join(wanted, "request_id", "left_semi").select(rows.columns)
    return rows.where(_any_of(F.col("request_id"), first) if first else F.lit(False))


def _any_of(c: Column, values: list[str]) -> Column:
    """One of the values, as a tree of equalities: of a longer list Spark hands the scan only the least and greatest."""
    if len(values) == 1:
        return c == values[0]
    half = len(values) // 2
    return _any_of(c, values[:half]) | _any_of(c, values[half:])


def fetch_sql(spark: SparkSession, table: str, request_id: str) -> DataFrame:
    """As :func:`fetch`, by a bound parameter on a catalogued table or view."""
    have = set(spark.table(table).columns)
    columns = ", ".join(c for c in EVENT_COLUMNS if c in have)
    return to_events(spark.sql(f"SELECT {columns} FROM {table} WHERE request_id = :request LIMIT 1", args={"request": request_id}))


def from_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Events in hand. Nested JSON may be objects or text."""
    as_text = lambda v: v if v is None or isinstance(v, (str, bool)) else json.dumps(v, ensure_ascii=False)
    flag = lambda v: {"true": True, "false": False}.get(v.strip().lower()) if isinstance(v, str) else v
    return spark.createDataFrame([tuple(flag(r.get(c)) if c == "has_embedding" else as_text(r.get(c)) for c in EVENT_COLUMNS) for r in rows], EVENT)


def read_json_file(spark: SparkSession, path: str) -> DataFrame:
    """Events of JSON files, one document each: an event or an array whose first element is one.

    A document without ``input_payload_json`` is itself the payload. What the human wrote falls back to the
    final impression.
    """
    doc = V.parse(F.col("value"))
    root = F.when(V.is_array(doc), F.try_variant_get(doc, "$[0]", "variant")).otherwise(doc)
    v = F.col("root")
    shown = {c: V.shown(V.at(v, c)) for c in EVENT_COLUMNS}
    inner = V.parse(shown["input_payload_json"])
    shown["input_payload_json"] = F.when(V.is_object(inner), shown["input_payload_json"]).otherwise(F.to_json(v))
    shown["human_impression"] = F.coalesce(F.nullif(shown["human_impression"], F.lit("")), shown["final_impression"])
    return to_events(spark.read.text(path, wholetext=True).select(root.alias("root")).select(*[c.alias(n) for n, c in shown.items()]))


def available(spark: SparkSession, place: str | None) -> bool:
    """Whether a table of that name, or else a path, is there to be read or written."""
    if not place:
        return False
    if "/" not in place and spark.catalog.tableExists(place):
        return True
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    try:
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    except Exception:  # noqa: BLE001  a store that can't be reached is not available
        return False


def health(spark: SparkSession, source: str | None, sink: str | None) -> dict[str, bool]:
    return {"source_available": available(spark, source), "sink_available": available(spark, sink)}

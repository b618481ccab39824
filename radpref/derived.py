"""Review events derived from the order tables, so that all of the engine can run over them at any scale.

A request is an order, a finding one of its line items; texts are one sentence for each item, some of them
negated, left out, or wrong in side, grade or size. Keys decide everything, so that SQL can say the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LABELS = ("Pneumothorax", "Fracture", "Pulmonary embolism", "PE", "Tuberculosis", "Pleural effusion", "Lung mass", "Cardiomegaly", "Nodule", "Atelectasis", "Consolidation", "Edema")
_LABEL = "CASE l_partkey % 12 " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(LABELS)) + " END"
_OTHER = "CASE l_partkey % 12 WHEN 0 THEN 'PTX' WHEN 1 THEN 'FX' WHEN 2 THEN 'PE' WHEN 3 THEN 'pulmonary embolism' WHEN 4 THEN 'TB' END"


def _sentence(variant: str) -> str:
    """SQL of one item's sentence; null where the item is left out. ``variant``: a number from 0 to 7."""
    side = f"CASE WHEN ({variant}) = 2 THEN CASE WHEN location LIKE '%left%' THEN 'right' WHEN location IS NOT NULL THEN 'left' END ELSE location END"
    grade = f"CASE WHEN ({variant}) = 3 THEN CASE WHEN severity = 'mild' THEN 'massive' WHEN severity IS NOT NULL THEN 'trace' END ELSE severity END"
    size = f"CASE WHEN size_mm IS NOT NULL THEN ' measuring ' || cast(cast(size_mm + CASE WHEN ({variant}) = 4 THEN 9 ELSE 0 END AS int) AS varchar(12)) || ' mm' ELSE '' END"
    views = f"CASE ({variant}) WHEN 6 THEN ' on pa and lateral views' WHEN 7 THEN ' on upright view' ELSE '' END"
    name = f"CASE WHEN ({variant}) = 5 THEN coalesce(other, label) ELSE label END"
    said = f"coalesce(({grade}) || ' ', '') || coalesce(({side}) || ' ', '') || {name} || {size} || {views} || '.'"
    return f"CASE WHEN ({variant}) = 0 THEN NULL WHEN ({variant}) = 1 THEN 'No ' || label || ' is seen.' ELSE {said} END"


#: One row for each item, in SQL that Spark and DuckDB both take.
ITEMS = f"""
WITH placed AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_returnflag,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS pos FROM lineitem
), described AS (
  SELECT l_orderkey, pos, {_LABEL} AS label, {_OTHER} AS other,
    CASE WHEN l_returnflag = 'R' THEN 'absent' WHEN l_partkey % 11 = 0 THEN 'uncertain' ELSE 'present' END AS presence,
    CASE l_suppkey % 6 WHEN 0 THEN 'mild' WHEN 1 THEN 'moderate' WHEN 2 THEN 'severe' WHEN 3 THEN 'displaced' WHEN 4 THEN 'large' END AS severity,
    CASE (l_partkey + l_suppkey) % 6 WHEN 0 THEN 'left upper lobe' WHEN 1 THEN 'right' WHEN 2 THEN 'bilateral' WHEN 3 THEN 'right lower lobe' WHEN 4 THEN 'midline' END AS location,
    CASE WHEN l_partkey % 3 = 0 THEN l_quantity END AS size_mm,
    (7 * l_partkey + 3 * l_suppkey + pos) % 8 AS gv, (5 * l_partkey + 11 * l_suppkey + pos) % 8 AS hv FROM placed
)
SELECT *, {_sentence("gv")} AS gen, {_sentence("hv")} AS hum FROM described
"""

#: One row for each order, beside its items.
REQUESTS = """
SELECT o_orderkey, cast(o_orderkey AS varchar(20)) AS request_id, n_name AS tenant_id, r_name AS site_id,
  CASE o_orderkey % 6 WHEN 0 THEN 'accepted' WHEN 1 THEN 'edited' WHEN 2 THEN 'modified' WHEN 3 THEN 'rejected' WHEN 5 THEN 'Deferred ' END AS disposition,
  o_orderkey % 10 <> 0 AS send,
  CASE WHEN o_orderkey % 3 <> 0 THEN 'Summarize study ' || cast(o_orderkey AS varchar(20)) END AS prompt,
  CASE o_orderkey % 4 WHEN 0 THEN 'PA and lateral' WHEN 1 THEN 'AP upright' WHEN 2 THEN 'frontal' END AS projection,
  (o_orderkey % 21) / 10.0 - 1 AS reward, o_orderkey % 4 AS path, o_orderkey % 7 = 0 AS nested, o_orderdate
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


def _tables(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    """SQL over tables of a folder, without leaving views behind that other sessions' folders could take."""
    return spark.sql(_bound(sql, names), **{n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names})


def _bound(sql: str, names: tuple[str, ...]) -> str:
    for n in names:
        for word in ("FROM", "JOIN"):
            sql = sql.replace(f"{word} {n} ", f"{word} {{{n}}} {n} ").replace(f"{word} {n}\n", f"{word} {{{n}}} {n}\n")
    return sql


def _spread(requests: DataFrame) -> DataFrame:
    """Requests over all cores: few bytes a row, but much work, so that left to itself Spark would put small tables into one task."""
    spark = requests.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return requests.repartition(parts, "o_orderkey")


def derived_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the input schema, with JSON text payloads."""
    items = _tables(spark, sf_dir, ITEMS, "lineitem")
    finding = F.struct("label", "presence", "severity", "location", F.when(F.col("size_mm").isNotNull(), F.struct("size_mm", F.lit(10.0).alias("tolerance_pct"))).alias("measurements"))
    texts = lambda c: F.nullif(F.array_join(F.transform(F.filter("all", lambda x: x[c].isNotNull()), lambda x: x[c]), " "), F.lit(""))
    by = items.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("pos", "gen", "hum", finding.alias("f")))).alias("all"))
    by = by.select("l_orderkey", F.transform("all", lambda x: x["f"]).alias("findings"), texts("gen").alias("gen"), texts("hum").alias("hum"))
    both = _tables(spark, sf_dir, REQUESTS, "orders", "customer", "nation", "region").join(by, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    prompt = lambda k: F.when(F.col("path") == k, F.col("prompt"))
    nested = F.when(F.col("nested"), F.col("gen"))
    payload = F.to_json(F.struct(
        F.struct(F.struct(F.lit("DX").alias("modality"), F.lit("CHEST").alias("body_part"), "projection").alias("exam")).alias("case"),
        F.struct(F.struct(F.coalesce("findings", F.array()).alias("structured_findings")).alias("observation_payload")).alias("inputs"),
        F.struct(F.struct(F.when(F.col("path") < 2, nested).alias("impression_text")).alias("output"), F.lit(" draft-2 ").alias("model")).alias("generator_response"),
        F.when(F.col("path") >= 2, nested).alias("impression_text"),
        prompt(0).alias("prompt_text"),
        prompt(1).alias("prompt"),
        F.struct(prompt(2).alias("prompt_text"), prompt(3).alias("prompt")).alias("generator_request"),
        F.struct(F.col("reward").cast("double").alias("score"), F.col("send").alias("send_to_curator")).alias("reward_signal"),
        F.struct(F.when(F.col("path") == 0, 0).otherwise(F.col("o_orderkey") % 100).alias("agent_latency_ms"), F.lit(7.5).alias("generation_ms"), F.when(F.col("path") == 3, F.col("o_orderkey") % 50).alias("evaluation_ms")).alias("timing"),
        F.struct(F.when(F.col("o_orderkey") % 5 == 0, " reflect-1").alias("model_version")).alias("reflector_response"),
        F.when(F.col("o_orderkey") % 5 == 1, "reflect-2").alias("reflector_model"),
        F.when(F.col("o_orderkey") % 3 == 0, "2026-01-02T03:04:05Z").alias("submitted_to_queue_at"),
        F.when(F.col("o_orderkey") % 4 == 0, "2026-01-02 03:04:06 UTC").alias("approved_at"),
    ))
    # every ninth payload is JSON text within a JSON string
    inner = F.to_json(F.struct(payload.alias("x")))
    payload = F.when(F.col("o_orderkey") % 9 == 0, F.substr(inner, F.lit(6), F.char_length(inner) - 6)).otherwise(payload)
    return _spread(both).select(
        "request_id",
        F.lit(None).cast("string").alias("event_id"),
        "tenant_id",
        "site_id",
        F.lit("PASS").alias("decision"),
        "disposition",
        *[F.lit(None).cast("string").alias(c) for c in ("expected_route", "actual_route", "expected_scope_key", "actual_scope_key", "impression_text")],
        F.when(~F.col("nested"), F.col("gen")).alias("generated_impression"),
        F.lit(None).cast("string").alias("final_impression"),
        F.col("hum").alias("human_impression"),
        F.when(F.col("path") == 1, '[{"code": "BAD_ROUTE"}, {"code": ""}, 7]').when(F.col("path") == 2, "[]").alias("issues_json"),
        payload.alias("input_payload_json"),
        F.lit(True).alias("has_embedding"),
    )


def derived_judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A judge's answers for derived events: ``request_id, evaluation, prompt_tokens, completion_tokens, total_tokens``.

    Ids are given as they are, in other spelling, or not at all (then the label has to do).
    """
    items = _tables(spark, sf_dir, ITEMS, "lineitem")
    status = lambda v: F.when(F.col(v) == 0, "not_mentioned").when(F.col(v) == 1, "negated").when(F.col(v) == 2, "uncertain").otherwise(" Mentioned")

    def side(v: str):
        return F.struct(
            status(v).alias("mention_status"),
            F.col("location").isNotNull().alias("laterality_applicable"),
            F.when(F.col("location").isNotNull() & (F.col(v) != 7), F.col(v) != 2).alias("laterality_correct"),
            F.col("severity").isNotNull().alias("severity_applicable"),
            F.when(F.col("severity").isNotNull(), F.col(v) != 3).alias("severity_correct"),
            (F.col(v) > 2).alias("critical_captured"),
            F.lit(None).cast("string").alias("evidence"),
        )

    pos = F.col("pos").cast("string")
    ident = F.when(F.col("pos") % 3 == 0, F.concat(F.lit("Finding-"), pos)).when((F.col("pos") % 3 == 1) & (F.col("gv") == 6), "unknown").otherwise(F.concat(F.lit("finding_"), pos))
    judgment = F.struct(
        ident.alias("finding_id"), "label", "presence", F.lit(None).cast("string").alias("normalized_finding_type"),
        (F.col("severity") == "severe").alias("is_critical"), side("gv").alias("generated"), side("hv").alias("human"), F.lit(None).cast("string").alias("reasoning"),
    )
    extra = F.struct("label", F.lit(None).cast("string").alias("location"), F.lit("").alias("severity"), F.lit(None).cast("string").alias("evidence"), F.lit(None).cast("string").alias("confidence"))
    at = F.col("pos")
    by = items.groupBy(F.col("l_orderkey").cast("string").alias("request_id")).agg(
        F.sort_array(F.collect_list(F.struct(at, judgment.alias("j")))).alias("all"),
        F.collect_list(F.when((F.col("gv") == 3) & (F.col("presence") == "absent"), extra)).alias("more"),
        F.count("*").alias("n"),
    )
    none = F.array().cast("array<string>")
    evaluation = F.struct(
        F.transform("all", lambda x: x["j"]).alias("finding_judgments"),
        F.col("more").alias("hallucinated_findings_generated"),
        F.filter("more", lambda _: F.lit(False)).alias("hallucinated_findings_human"),
        none.alias("agreement_common_finding_ids"),
        none.alias("agreement_generated_only_finding_ids"),
        none.alias("agreement_human_only_finding_ids"),
        F.lit(None).cast("string").alias("reasoning"),
    )
    return by.select("request_id", evaluation.alias("evaluation"), (F.col("n") * 100).alias("prompt_tokens"), (F.col("n") * 40).alias("completion_tokens"), (F.col("n") * 140).alias("total_tokens"))


def derived_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upstream requests as JSON text: ``request_id, request``. Keys decide which fields are wrong or missing."""
    items = _tables(spark, sf_dir, ITEMS, "lineitem")
    gv, hv, k = F.col("gv"), F.col("hv"), F.col("o_orderkey")
    confidence = F.when(hv == 5, 1.5).when(hv != 4, F.col("pos") % 5 / 4.0)
    finding = F.struct(F.when(gv != 7, F.col("label")).alias("label"), F.when(hv == 6, "maybe").otherwise(F.col("presence")).alias("presence"), "severity", confidence.alias("confidence"))
    by = items.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("pos", finding.alias("f")))).alias("all")).select("l_orderkey", F.transform("all", lambda x: x["f"]).alias("findings"))
    both = _tables(spark, sf_dir, REQUESTS, "orders", "customer", "nation", "region").join(by, k == F.col("l_orderkey"), "left")
    either = lambda wrong, bad, good: F.when(wrong, F.parse_json(F.lit(bad))).otherwise(F.parse_json(F.lit(good)))
    exam = F.struct(F.when(k % 5 == 0, "XX").otherwise("CT").alias("modality"), F.lit("CHEST").alias("body_part"), F.when(k % 9 == 0, "Q").alias("laterality"))
    request = F.struct(
        "tenant_id", "request_id",
        F.struct(F.lit("u1").alias("user_id"), F.when(k % 7 == 0, "visitor").otherwise("clinician").alias("role")).alias("user"),
        F.struct(F.when(k % 8 != 0, F.concat(F.lit("A"), "request_id")).alias("accession_number"), F.struct(F.lit("P1").alias("patient_id")).alias("patient"), exam.alias("exam"), either(k % 11 == 0, "7", '"cough"').alias("clinical_indication")).alias("case"),
        F.struct(F.struct(F.col("findings").alias("structured_findings")).alias("observation_payload")).alias("inputs"),
        F.when(k % 10 != 0, F.struct(F.lit("pb").alias("playbook_id"), F.lit("1").alias("playbook_version"))).alias("ace_context"),
        F.struct(either(k % 6 == 0, '"many"', '"3"').alias("top_k")).alias("retrieval"),
    )
    return _spread(both).select("request_id", F.to_json(request).alias("request"))

"""Registered queries of the engine, each over whole tables, with SQL that gives the same rows."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from radpref.contracts import faults, typed
from radpref.derived import ITEMS, REQUESTS, derived_events, derived_judgments, derived_requests
from radpref.functions import text as T
from radpref.functions import variants as V
from radpref.operators.answers import answers_to, ask_missing
from radpref.operators.clinical import clinical_accuracy as accuracy_of
from radpref.operators.clinical import finding_checks as finding_checks_of
from radpref.operators.feedback import edit_distance, estimated_cost, human_feedback, share_of
from radpref.operators.fields import field_performance as fields_of
from radpref.operators.fields import with_field_error
from radpref.operators.judge import judged_accuracy, parse_evaluation, prompts
from radpref.operators.judgments import finding_rows, judgment_rows, match_rows, matched_answers
from radpref.plans.curate import Settings, curate, flatten, prepare
from radpref.plans.rollups import daily_summary, merged, rollup_checks, rollup_requests, shown
from radpref.shared import shared_dir
from radpref.sources.events import fetch, fetch_many
from radpref.sources.output import keyed_writer, read_output, training_records
from radpref.sources.quarantine import Quarantine
from radpref.streaming.stream import curate_stream, first_of_repeats, read_stream
from radpref.streaming.traces import Traces

RATES = ("finding_recall", "finding_precision", "false_negative_rate", "critical_finding_capture_rate", "laterality_accuracy", "severity_accuracy", "absent_finding_accuracy")
_ACCURACY = [f"{r}_{t}" for r in RATES for t in ("generated", "human")] + ["impression_agreement_score", "clinical_accuracy_score"]
_COUNTS = ["total_findings_checked", "present_findings_count", "critical_findings_count", "findings_with_laterality", "findings_with_severity", "absent_findings_count"]
_FLAT = ["request_id", "tenant_id", "site_id", "modality", "body_part", "disposition", "prompt_text", "has_dpo_pair", "is_dpo_ready", "is_dpo_training_ready", "reward_score", "reward_label", "is_human_overridden", "is_human_accepted", "human_feedback_edit_distance", "human_feedback_normalized_edit_distance", "human_reward_score", "curator_reward_score", "clinical_accuracy_score", "finding_recall_generated", "impression_agreement_score", "laterality_error_rate", "severity_error_rate", "projection_error_rate", "measurement_error_rate", "overall_field_error_rate", "reflector_triggered", "agent_latency_ms", "generator_model_version"]


def _placed(events: DataFrame, *more: str) -> DataFrame:
    """Prepared events whose findings can be graded and that are not skipped, with what the grading named needs and no more."""
    return prepare(events, "is_skipped", "placed", *more).where("not is_skipped and placed is not null")


def event_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request by key."""
    return fetch(derived_events(spark, sf_dir), "1").select("request_id", "tenant_id", "site_id", "disposition", "generated_impression", "human_impression")


def event_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requests of all urgent orders by key, out of stored events with Bloom filters."""
    path = shared_dir(spark, "events")
    keyed_writer(derived_events(spark, sf_dir)).parquet(path)
    urgent = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").cast("string").alias("request_id"))
    return fetch_many(spark.read.parquet(path), urgent).select("request_id", "tenant_id", "site_id", "disposition", "generated_impression", "human_impression")


def request_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with every upstream request, and some typed values with their defaults."""
    r = derived_requests(spark, sf_dir).select("request_id", F.parse_json("request").alias("r"))
    r = r.select("request_id", F.sort_array(faults(F.col("r"), "request")).alias("faults"), typed(F.col("r"), "request").alias("t"))
    return r.select(
        "request_id", F.size("faults").cast("long").alias("n_faults"), F.array_join("faults", "; ").alias("faults"), F.col("t.retrieval.top_k").alias("top_k"), F.col("t.retrieval.enabled").alias("enabled"),
        F.col("t.case.patient.sex").alias("sex"), F.col("t.ace_context.specialty_profile").alias("profile"), F.size("t.inputs.observation_payload.structured_findings").cast("long").alias("n_findings"),
    )


def payload_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fallback chains over every payload."""
    names = ["generated", "generator_output_source", "fallback_used", "prompt_text", "projection", "generator_model_version", "agent_latency_ms", "reward_score", "reflector_triggered"]
    p = prepare(derived_events(spark, sf_dir), *names, "issue_codes", "findings")
    return p.select("request_id", *names, F.array_join("issue_codes", ",").alias("issue_codes"), F.coalesce(F.size("findings"), F.lit(0)).cast("long").alias("n_findings"))


def event_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A typed path into the JSON properties of an event stream."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select("event_id", V.number_at(V.parse(F.col("props")), "k").alias("k"))


def readiness_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gate, readiness and completeness of every request."""
    r = F.col("response")
    out = curate(derived_events(spark, sf_dir), metrics=False)
    return out.select(
        "request_id",
        r["trace"]["skipped"].alias("skipped"),
        r["readiness"]["has_prompt"].alias("has_prompt"),
        r["readiness"]["has_dpo_pair"].alias("has_dpo_pair"),
        r["readiness"]["is_dpo_ready"].alias("is_dpo_ready"),
        F.array_join(r["readiness"]["missing_fields"], ",").alias("missing_fields"),
        r["scores"]["data_completeness_score"].alias("data_completeness_score"),
        r["scores"]["dpo_readiness_score"].alias("dpo_readiness_score"),
        r["reward_label"].alias("reward_label"),
    )


def document_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of every document, and how many are negated."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("s", T.sentences(T.normalize(F.col("text"))))
    long = lambda c: c.cast("long")
    return d.select("doc_id", long(F.size("s")).alias("n_sentences"), long(F.size(F.filter("s", T.is_negated))).alias("n_negated"), long(F.char_length(F.array_join("s", ""))).alias("n_chars"))


def finding_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every finding of every request against both texts."""
    c = _placed(derived_events(spark, sf_dir)).select("request_id", F.posexplode(finding_checks_of(F.col("placed"))).alias("pos", "c"))
    names = ["label", "presence", "severity", "location", "mentioned_in_generated", "mentioned_in_human", "laterality_match_generated", "laterality_match_human", "severity_match_generated", "severity_match_human", "is_critical", "critical_captured_generated", "critical_captured_human"]
    return c.select("request_id", (F.col("pos") + 1).cast("long").alias("pos"), *[F.col(f"c.{n}").alias(n) for n in names])


def clinical_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rates and counts of every request that can be graded."""
    ca = accuracy_of(_placed(derived_events(spark, sf_dir), "generated")).select("request_id", F.col("clinical_accuracy").alias("ca"))
    missed = F.array_join("ca.missed_findings_generated", ",").alias("missed")
    return ca.select("request_id", *[F.col(f"ca.{n}").alias(n) for n in [*_ACCURACY, *_COUNTS]], missed)


def field_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors by field of every request that can be graded."""
    fp = fields_of(_placed(derived_events(spark, sf_dir), "projection")).select("request_id", F.col("field_performance").alias("fp"))
    names = [f"{k}_{e}" for k in ("laterality", "severity", "projection", "measurement") for e in ("applicable", "errors", "error_rate")]
    return fp.select("request_id", *[F.col(f"fp.{n}").alias(n) for n in [*names, "total_field_checks", "total_field_errors", "overall_field_error_rate"]])


def feedback_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dispositions, edit distances and rewards of every request not skipped."""
    p = prepare(derived_events(spark, sf_dir), "is_skipped", "placed", "generated", "gen_normal", "hum_normal").where("not is_skipped")
    hf = human_feedback(accuracy_of(p)).select("request_id", F.col("human_feedback").alias("hf"))
    return hf.select("request_id", "hf.*")


def conversation_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edit distance of each turn and the one before it, over the code points of the whole texts; of a repeated turn the least text."""
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet").groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    now = c.select("conv_id", "turn", T.normalize_for_distance(F.coalesce("text", F.lit(""))).alias("now"))
    before = now.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("now").alias("before"))
    both = now.join(before, ["conv_id", "turn"]).withColumn("distance", edit_distance(F.col("before"), F.col("now"))[0])
    return both.select("conv_id", "turn", "distance", share_of(F.col("distance"), F.col("before"), F.col("now")).alias("share"))


def training_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt, chosen and rejected of all requests ready for training."""
    return training_records(flatten(curate(derived_events(spark, sf_dir), metrics=False)))


def output_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scalar columns of the output table, skipped requests included."""
    return flatten(curate(derived_events(spark, sf_dir))).select(*_FLAT)


#: Columns of the output table that :func:`output_rows` leaves out, but for the JSON ones below and the time of the run.
_REST = ["event_id", "decision", "actual_route", "expected_route", "actual_scope_key", "expected_scope_key", "preferred_output", "dispreferred_output", "missing_fields", "latency_ms", "has_generated_output", "has_human_reference", "finding_precision_generated", "critical_finding_capture_rate_generated", "laterality_accuracy_generated", "severity_accuracy_generated", "missed_findings_generated", "missed_critical_generated", "hallucinated_findings_generated", "total_tokens", "prompt_tokens", "completion_tokens", "estimated_cost_usd", "reflector_model_version", "clinical_accuracy_mode", "eval_latency_ms", "dpo_record"]
_JSON_PATHS = {
    "recall_human": ("clinical_accuracy_json", "$.finding_recall_human", "double"),
    "findings_checked": ("clinical_accuracy_json", "$.total_findings_checked", "long"),
    "first_label": ("finding_checks_json", "$[0].label", "string"),
    "first_mentioned": ("finding_checks_json", "$[0].mentioned_in_human", "boolean"),
    "field_checks": ("field_performance_json", "$.total_field_checks", "long"),
    "feedback_disposition": ("human_feedback_json", "$.disposition", "string"),
    "feedback_reward": ("human_feedback_json", "$.curator_reward_score", "double"),
    "analytics_recall": ("analytics_json", "$.clinical_accuracy.finding_recall_generated", "double"),
    "analytics_errors": ("analytics_json", "$.field_performance.total_field_errors", "long"),
    "response_skipped": ("curator_response", "$.trace.skipped", "boolean"),
    "response_status": ("curator_response", "$.trace.status", "string"),
    "response_prompt": ("curator_response", "$.training_example.prompt_input.prompt_text", "string"),
    "response_ready": ("curator_response", "$.readiness.is_dpo_ready", "boolean"),
}


def output_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other columns of the output table, the JSON ones by values within them."""
    rows = flatten(curate(derived_events(spark, sf_dir)))
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    within = [F.get_json_object(c, path).cast(kind).alias(name) for name, (c, path, kind) in _JSON_PATHS.items()]
    return rows.select("request_id", *_REST, stamp("submitted_to_queue_at"), stamp("human_approved_at"), F.col("created_at").isNotNull().alias("has_created_at"), *within)


def tenant_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and mean scores by tenant and disposition."""
    return rollup_requests(flatten(curate(derived_events(spark, sf_dir))), "tenant_id", "disposition")


def dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored summaries by tenant, disposition and version, merged over several levels; the exact columns of what is shown."""
    rows = flatten(curate(derived_events(spark, sf_dir))).withColumn("created_date", F.to_date("created_at"))
    path = shared_dir(spark, "summaries")
    daily_summary(rows, "tenant_id", "body_part", "disposition", "generator_model_version").write.parquet(path)
    levels = merged(spark.read.parquet(path), (), ("tenant_id",), ("disposition", "generator_model_version"), ("tenant_id", "body_part", "disposition"))
    names = ["level", "tenant_id", "body_part", "disposition", "generator_model_version", "requests", "with_pair", "dpo_ready", "training_ready", "overridden"]
    return shown(levels).select(*names, *[f"mean_{s}" for s in ("clinical_accuracy_score", "finding_recall_generated", "overall_field_error_rate", "curator_reward_score")])


def label_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks by label over all requests."""
    return rollup_checks(_placed(derived_events(spark, sf_dir)).select(F.explode(finding_checks_of(F.col("placed"))).alias("c")))


def judge_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates from stored judge answers, matched by id, by the id's key, or by label."""
    return _judged_rates(derived_events(spark, sf_dir), derived_judgments(spark, sf_dir))


def judge_accuracy_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from judgments that are rows, matched to rows of findings by joins."""
    events, path = derived_events(spark, sf_dir), shared_dir(spark, "judgments")
    answers = derived_judgments(spark, sf_dir)
    judgment_rows(answers).write.parquet(f"{path}/judgments")
    finding_rows(prepare(events, "is_skipped", "can_grade", "findings")).write.parquet(f"{path}/findings")
    matches = match_rows(spark.read.parquet(f"{path}/findings"), spark.read.parquet(f"{path}/judgments"))
    bare = answers.withColumn("evaluation", F.col("evaluation").withField("finding_judgments", F.filter("evaluation.finding_judgments", lambda _: F.lit(False))))
    return _judged_rates(events, matched_answers(matches, bare))


def literal_judge() -> Callable[[str], dict]:
    """A stand-in for a judge: an impression mentions a finding if it holds the label's letters. Answers in a code fence, as models do."""

    def answer(prompt: str) -> dict:
        given = json.loads(prompt[prompt.rindex("\nINPUT:\n") + 8 :])
        found = [json.loads(line) for line in given["structured_findings"].split("\n")]
        said = lambda f, t: {"mention_status": "mentioned" if f["label"].lower() in given[f"{t}_impression"].lower() else "not_mentioned"}
        judged = [{"finding_id": f["finding_id"], "label": f["label"], "generated": said(f, "generated"), "human": said(f, "human")} for f in found]
        return {"answer": "```json\n" + json.dumps({"finding_judgments": judged}) + "\n```", "prompt_tokens": len(found), "completion_tokens": 1, "total_tokens": len(found) + 1}

    return answer


def judge_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts of all requests, asked into a table of answers in two runs, and what the answers say, finding by finding."""
    path, events = shared_dir(spark, "answers"), derived_events(spark, sf_dir)
    prompts(prepare(events, "is_skipped", "can_grade", "findings", "case", "generated")).write.parquet(f"{path}/asked")
    asked = spark.read.parquet(f"{path}/asked")
    ask_missing(asked, f"{path}/answers", literal_judge)
    again = ask_missing(asked, f"{path}/answers", literal_judge)
    told = answers_to(asked, f"{path}/answers").select("request_id", "prompt_tokens", F.posexplode(parse_evaluation(F.col("answer"))["finding_judgments"]).alias("at", "j"))
    said = lambda t: (F.col(f"j.{t}.mention_status") == "mentioned").alias(f"in_{t}")
    return told.select("request_id", (F.col("at") + 1).cast("long").alias("pos"), F.col("j.finding_id").alias("finding_id"), F.col("j.label").alias("label"), said("generated"), said("human"), "prompt_tokens", F.lit(again).cast("long").alias("asked_again"))


def _judged_rates(events: DataFrame, answers: DataFrame) -> DataFrame:
    p = prepare(events, "is_skipped", "payload_failed", "placed", "findings", "can_grade").where("not is_skipped")
    out = with_field_error(judged_accuracy(p, answers))
    error = F.coalesce(F.when(F.col("payload_failed"), "payload is not JSON"), F.col("judge_failed"), F.col("field_error"))
    cost = estimated_cost(F.col("judge_prompt_tokens"), F.col("judge_completion_tokens"), Settings().provider)
    shown = out.select("request_id", F.col("clinical_accuracy").alias("ca"), error.alias("error"), cost.alias("cost"))
    return shown.select("request_id", "error", "cost", *[F.col(f"ca.{n}").alias(n) for n in _ACCURACY], F.col("ca.generated_supported_mentions_count").alias("supported"))


def streamed_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The output rows again, by way of a stream into the append-only table."""
    path = shared_dir(spark, "stream")
    derived_events(spark, sf_dir).write.parquet(f"{path}/in")
    curate_stream(read_stream(spark, f"{path}/in"), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return read_output(spark, f"{path}/out").select(*_FLAT)


def traced_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the traces of a stream hold that took half of the events, was stopped, and took the others: counts of its batches, added up."""
    path = shared_dir(spark, "traced")
    events, traces = derived_events(spark, sf_dir), Traces(spark, f"{path}/traces")
    with traces.listening():
        for k in range(2):
            with traces.stage("arrival"):
                events.where(F.col("request_id").cast("long") % 2 == k).write.mode("append").parquet(f"{path}/in")
            curate_stream(read_stream(spark, f"{path}/in"), f"{path}/out", f"{path}/checkpoint", counts=traces.counts(f"{path}/checkpoint")).awaitTermination()
    with traces.stage("output") as counts:
        counts["rows"] = read_output(spark, f"{path}/out").count()
    shown = ("rows", "skipped", "dpo_ready", "missing_generated_impression", "missing_human_impression", "missing_prompt_text", "input_rows")
    each = traces.rows().select("kind", F.explode("counts").alias("count", "value")).where(F.col("count").isin(*shown))
    return each.groupBy("kind", "count").agg(F.sum(F.col("value").cast("long")).alias("value"))


def unrepeated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of each run of a user's events of one type, each within a day of the one before; a stream over three spans of time, stopped and started again between them."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    path = shared_dir(spark, "repeats")
    for k in range(3):
        low, high = (first + (last - first) / 3 * i for i in (k, k + 1)) if first else (None, None)
        span = (F.col("ts") >= F.lit(low)) & ((F.col("ts") < F.lit(high)) | F.lit(k == 2))
        events.where(span).write.mode("append").parquet(f"{path}/in")
        source = spark.readStream.schema(events.schema).parquet(f"{path}/in")
        runs = first_of_repeats(source, "ts", ["user_id", "event_type"], "1 day", "2 days")
        runs.writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start(f"{path}/out").awaitTermination()
    runs = spark.read.schema(runs.schema).parquet(f"{path}/out")
    return runs.select("event_id", "user_id", "event_type", "value", F.unix_micros("ts").alias("first_us"), F.unix_micros("last_time").alias("last_us"), "repeats")


def quarantine_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events damaged in three ways taken in, and a replay that can mend one of them: where each event is, why, and after how many tries."""
    k, payload = F.col("request_id").cast("long"), F.col("input_payload_json")
    damaged = F.when(k % 13 == 0, F.concat(F.lit(")]}',"), payload)).when(k % 17 == 0, F.concat(F.lit("["), payload, F.lit("]"))).when(k % 19 == 0, F.substring(payload, 1, 40)).otherwise(payload)
    store = Quarantine(spark, shared_dir(spark, "quarantine"))
    store.take_in(derived_events(spark, sf_dir).withColumn("input_payload_json", damaged))
    store.replay(lambda e: e.withColumn("input_payload_json", F.regexp_replace("input_payload_json", r"^\)\]\}',", "")))
    exam = V.text_at(V.parse(payload), "case.exam.modality").alias("modality")
    good = store.good().select("request_id", F.lit("good").alias("place"), F.lit(None).cast("string").alias("fault"), F.col("tries").cast("long"), exam)
    return good.unionByName(store.waiting().select("request_id", F.lit("waiting").alias("place"), "fault", F.col("tries").cast("long"), F.lit(None).cast("string").alias("modality")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (output_rows, output_details, event_lookup, event_lookups, request_contracts, payload_extraction, event_properties, readiness_scores, document_sentences, finding_checks, clinical_accuracy, field_performance, feedback_rewards, training_export, tenant_rollup, label_rollup, judge_accuracy, judge_accuracy_by_join, judge_answers, streamed_output, traced_batches, unrepeated_events, dashboard, quarantine_replay)}

#: Without SQL: DuckDB's levenshtein counts bytes, not code points.
NO_SQL: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (conversation_edits,)}

# --- the same in DuckDB's SQL ---

_NEGATED = r"regexp_matches(s, '(^|[^\p{L}\p{N}_])(" + "|".join(T.NEGATIONS) + r")($|[^\p{L}\p{N}_])')"
_OTHER = "CASE lower(label) " + " ".join(f"WHEN '{a}' THEN '{b}'" for k, v in T.ABBREVIATIONS.items() for a, b in ((k, v), (v, k))) + " END"


def _word(s: str, terms: str) -> str:
    return f"regexp_matches({s}, '\\b(' || {terms} || ')\\b')"


def _sql_by_key(key: str, sentence: str, table: dict[str, tuple[str, ...]]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {_word(sentence, repr('|'.join(v)))}" for k, v in table.items())
    return f"CASE WHEN {sentence} IS NOT NULL THEN CASE {key} {whens} END END"


_SIDE = "CASE " + " ".join(f"WHEN contains(lower(location), '{t}') THEN '{s}'" for t, s in T.LOCATION_SIDES) + " END"
_GRADE = "CASE " + " ".join(f"WHEN contains(lower(severity), '{k}') OR contains('{k}', lower(severity)) THEN '{k}'" for k in T.SEVERITY_TERMS) + " END"
_VIEWS = {"PA and lateral": ("pa", "lateral"), "AP upright": ("ap", "upright"), "frontal": ("frontal",)}
_VIEWS_OK = "CASE projection " + " ".join(f"WHEN '{p}' THEN " + " AND ".join(_word("s_g", repr("|".join(T.VIEW_TERMS[v]))) for v in vs) for p, vs in _VIEWS.items()) + " END"

#: Graded findings, by relations instead of arrays.
_GRADED = f"""
WITH items AS ({ITEMS}), req AS ({REQUESTS}),
texts AS (SELECT l_orderkey, string_agg(gen, ' ' ORDER BY pos) AS gen, string_agg(hum, ' ' ORDER BY pos) AS hum, count(*) AS n FROM items GROUP BY 1),
full_req AS (SELECT req.*, gen, hum, coalesce(n, 0) AS n, send AND coalesce(n, 0) > 0 AND (gen IS NOT NULL OR hum IS NOT NULL) AS graded
  FROM req LEFT JOIN texts ON o_orderkey = l_orderkey),
sent AS (SELECT l_orderkey AS o, pos AS p, 'g' AS t, lower(gen) AS s FROM items WHERE gen IS NOT NULL
  UNION ALL SELECT l_orderkey, pos, 'h', lower(hum) FROM items WHERE hum IS NOT NULL),
affirmed AS (SELECT * FROM sent WHERE NOT {_NEGATED}),
hits AS (SELECT i.l_orderkey, i.pos, t, p, s, CASE WHEN {_word("s", "lower(label)")} THEN 1 WHEN {_word("s", _OTHER)} THEN 2 END AS tier FROM items i JOIN affirmed ON o = i.l_orderkey),
best AS (SELECT l_orderkey, pos, max(CASE WHEN t = 'g' THEN s END) AS s_g, max(CASE WHEN t = 'h' THEN s END) AS s_h
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, pos, t ORDER BY tier, p) AS k FROM hits WHERE tier IS NOT NULL) WHERE k = 1 GROUP BY 1, 2),
checks AS (SELECT request_id, o_orderkey, i.pos, label, presence, severity, location, size_mm, projection, s_g, s_h,
    s_g IS NOT NULL AS mentioned_in_generated, s_h IS NOT NULL AS mentioned_in_human,
    {_sql_by_key(_SIDE, "s_g", T.SIDE_TERMS)} AS laterality_match_generated, {_sql_by_key(_SIDE, "s_h", T.SIDE_TERMS)} AS laterality_match_human,
    {_sql_by_key(_GRADE, "s_g", T.SEVERITY_TERMS)} AS severity_match_generated, {_sql_by_key(_GRADE, "s_h", T.SEVERITY_TERMS)} AS severity_match_human,
    coalesce(regexp_matches(severity, '{"|".join(T.CRITICAL_GRADES)}'), false) AS is_critical,
    {_SIDE} AS side, {_GRADE} AS grade
  FROM items i JOIN full_req ON i.l_orderkey = o_orderkey AND graded LEFT JOIN best b ON b.l_orderkey = i.l_orderkey AND b.pos = i.pos)
"""


def _even(x: str, places: int) -> str:
    """Rounding of the decimal value that a double shows, ties to even."""
    d = f"cast(cast({x} AS varchar) AS decimal(34, 21)) * {10**places}"
    return f"cast(floor({d}) + CASE WHEN {d} - floor({d}) > 0.5 OR ({d} - floor({d}) = 0.5 AND abs(cast(floor({d}) AS bigint)) % 2 = 1) THEN 1 ELSE 0 END AS double) / {10**places}"


def _rate(n: str, d: str) -> str:
    return f"CASE WHEN ({d}) <> 0 THEN round_even(cast({n} AS double) / ({d}), 4) END"


def _accuracy_sql() -> str:
    n = lambda c: f"count(*) FILTER (WHERE {c})"
    distinct = lambda c: f"count(DISTINCT label) FILTER (WHERE {c})"
    present = n("presence = 'present'")
    out, named = [], {}
    for t in ("generated", "human"):
        hit = f"mentioned_in_{t}"
        # a label is true if any of the request's findings by that name is present
        named[t] = distinct(hit)
        out += [
            f"{_rate(n(f'presence = {q('present')} AND {hit}'), present)} AS finding_recall_{t}",
            f"{_rate(distinct(f'{hit} AND label_present'), named[t])} AS finding_precision_{t}",
            f"{_rate(n(f'presence = {q('present')} AND NOT {hit}'), present)} AS false_negative_rate_{t}",
            f"{_rate(n(f'presence = {q('present')} AND is_critical AND {hit}'), n(f'presence = {q('present')} AND is_critical'))} AS critical_finding_capture_rate_{t}",
            f"{_rate(n(f'laterality_match_generated IS NOT NULL AND laterality_match_{t}'), n('laterality_match_generated IS NOT NULL'))} AS laterality_accuracy_{t}",
            f"{_rate(n(f'severity_match_generated IS NOT NULL AND severity_match_{t}'), n('severity_match_generated IS NOT NULL'))} AS severity_accuracy_{t}",
            f"{_rate(n(f'presence = {q('absent')} AND {has(t)} AND NOT {hit}'), n(f'presence = {q('absent')}'))} AS absent_finding_accuracy_{t}",
        ]
    both = distinct("label_gen AND label_hum")
    either = distinct("label_gen OR label_hum")
    counts = {"total_findings_checked": "true", "present_findings_count": "presence = 'present'", "critical_findings_count": "presence = 'present' AND is_critical", "findings_with_laterality": "laterality_match_generated IS NOT NULL", "findings_with_severity": "severity_match_generated IS NOT NULL", "absent_findings_count": "presence = 'absent'"}
    return f"""{_GRADED}, named AS (SELECT c.*, gen IS NOT NULL AS has_generated, hum IS NOT NULL AS has_human,
  bool_or(c.presence = 'present') OVER w AS label_present, bool_or(mentioned_in_generated) OVER w AS label_gen, bool_or(mentioned_in_human) OVER w AS label_hum
  FROM checks c JOIN full_req USING (request_id) WINDOW w AS (PARTITION BY c.request_id, label)),
rates AS (SELECT request_id, {", ".join(out)}, {_rate(both, either)} AS impression_agreement_score,
  {", ".join(f"{n(c)} AS {k}" for k, c in counts.items())},
  coalesce(string_agg(label, ',' ORDER BY pos) FILTER (WHERE presence = 'present' AND NOT mentioned_in_generated), '') AS missed,
  count(*) FILTER (WHERE presence = 'present' AND is_critical AND NOT mentioned_in_generated) AS n_missed_critical
  FROM named GROUP BY request_id),
accuracy AS (SELECT *, {_composite()} AS clinical_accuracy_score FROM rates)"""


def q(x: str) -> str:
    return f"'{x}'"


def has(t: str) -> str:
    return f"has_{t}"


def _composite() -> str:
    parts = [("finding_recall_generated", 0.30), ("critical_finding_capture_rate_generated", 0.25), ("(1.0 - false_negative_rate_generated)", 0.20), ("laterality_accuracy_generated", 0.15), ("severity_accuracy_generated", 0.10)]
    d = lambda x: f"cast({x} AS double)"
    total = " + ".join(f"coalesce({d(c)} * {d(w)}, {d(0)})" for c, w in parts)
    weight = " + ".join(f"CASE WHEN {c} IS NOT NULL THEN {d(w)} ELSE {d(0)} END" for c, w in parts)
    return f"CASE WHEN ({weight}) > 0 THEN {_even(f'(({total}) / ({weight}))', 4)} END"


def _fields_sql() -> str:
    sizes = r"regexp_extract_all(s_g, '(\d+\.?\d*)\s*(?:x|by)?\s*(\d+\.?\d*)?\s*(cm|mm|centimeters?|millimeters?)', 1)"
    fits = f"len(list_filter({sizes}, lambda v: abs(cast(v AS double) - size_mm) / size_mm * 100 <= 10.0)) > 0"
    apt = {"laterality": "side IS NOT NULL", "severity": "grade IS NOT NULL", "projection": "views IS NOT NULL", "measurement": "size_mm IS NOT NULL"}
    bad = {"laterality": "NOT laterality_match_generated", "severity": "NOT severity_match_generated", "projection": "NOT views", "measurement": "NOT fits"}
    n = lambda c: f"count(*) FILTER (WHERE mentioned_in_generated AND presence IN ('present', 'absent') AND {c})"
    cols = []
    for k in apt:
        a, e = n(apt[k]), n(f"{apt[k]} AND {bad[k]}")
        cols += [f"{a} AS {k}_applicable", f"{e} AS {k}_errors", f"{_rate(e, a)} AS {k}_error_rate"]
    a = " + ".join(n(apt[k]) for k in apt)
    e = " + ".join(n(f"{apt[k]} AND {bad[k]}") for k in apt)
    return f"""viewed AS (SELECT *, {_VIEWS_OK} AS views, {fits} AS fits FROM checks),
fields AS (SELECT request_id, {", ".join(cols)}, {a} AS total_field_checks, {e} AS total_field_errors, {_rate(f"({e})", f"({a})")} AS overall_field_error_rate FROM viewed GROUP BY request_id)"""


def _plain(c: str) -> str:
    squeeze = lambda x: f"regexp_replace({x}, '\\s+', ' ', 'g')"
    low = squeeze(f"lower(regexp_replace(regexp_replace({c}, '^\\s+', ''), '\\s+$', ''))")
    return f"regexp_replace(regexp_replace({squeeze(f"regexp_replace({low}, '\\s*([,.;:])\\s*', '\\1 ', 'g')")}, '^\\s+', ''), '\\s+$', '')"


def _judge_sql() -> str:
    n = lambda c: f"count(*) FILTER (WHERE {c})"
    here, critical = "presence = 'present'", "presence = 'present' AND severity = 'severe'"
    out = []
    for t, v in (("generated", "gv"), ("human", "hv")):
        said = f"{v} > 2"
        extra = "count(*) FILTER (WHERE gv = 3 AND presence = 'absent')" if t == "generated" else "0"
        sided, scaled = f"location IS NOT NULL AND {v} <> 7", "severity IS NOT NULL"
        out += [
            f"{_rate(n(f'{here} AND {said}'), n(here))} AS finding_recall_{t}",
            f"{_rate(n(f'{here} AND {said}'), f'{n(f"{here} AND {said}")} + {extra}')} AS finding_precision_{t}",
            f"{_rate(n(f'{here} AND NOT ({said})'), n(here))} AS false_negative_rate_{t}",
            f"{_rate(n(f'{critical} AND {said}'), n(critical))} AS critical_finding_capture_rate_{t}",
            f"{_rate(n(f'{sided} AND {v} <> 2'), n(sided))} AS laterality_accuracy_{t}",
            f"{_rate(n(f'{scaled} AND {v} <> 3'), n(scaled))} AS severity_accuracy_{t}",
            f"{_rate(n(f"presence = 'absent' AND NOT ({said})"), n("presence = 'absent'"))} AS absent_finding_accuracy_{t}",
        ]
    agree = _rate(n(f"{here} AND gv > 2 AND hv > 2"), n(f"{here} AND (gv > 2 OR hv > 2)"))
    return f"""{_GRADED}, lost AS (SELECT l_orderkey, pos, label, pos % 3 = 1 AND gv = 6 AND count(*) OVER (PARTITION BY l_orderkey, label) > 1 AS lost FROM items),
bad AS (SELECT l_orderkey, bool_or(lost) AS bad FROM lost GROUP BY 1),
rates AS (SELECT l_orderkey, {", ".join(out)}, {agree} AS impression_agreement_score, {n(f"{here} AND gv > 2")} AS supported FROM items GROUP BY 1),
scored AS (SELECT *, {_composite()} AS clinical_accuracy_score FROM rates),
good AS (SELECT scored.* FROM scored JOIN bad USING (l_orderkey) WHERE NOT bad)
SELECT request_id, CASE WHEN graded AND bad THEN 'no judgment of a finding' END AS error,
  CASE WHEN n > 0 THEN {_even("(n * 100 / 1000.0::double * 0.000125::double + n * 40 / 1000.0::double * 0.000375::double)", 6)} END AS cost,
  {", ".join(f"CASE WHEN graded THEN {c} END AS {c}" for c in [*_ACCURACY, "supported"])}
FROM full_req LEFT JOIN good ON good.l_orderkey = o_orderkey LEFT JOIN bad ON bad.l_orderkey = o_orderkey WHERE send"""


_FEEDBACK = f"""plain AS (SELECT *, lower(trim(disposition)) AS d, {_plain("coalesce(gen, '')")} AS g, {_plain("coalesce(hum, '')")} AS h FROM full_req WHERE send),
dist AS (SELECT *, CASE WHEN g <> '' AND h <> '' THEN levenshtein(g, h) END AS dist FROM plain),
shares AS (SELECT *, CASE WHEN dist IS NOT NULL THEN round_even(cast(dist AS double) / greatest(length(g), length(h), 1), 4) WHEN d = 'rejected' THEN 1.0 END AS share FROM dist),
feedback AS (SELECT request_id, d AS disposition, CASE WHEN d IS NOT NULL THEN d IN ('edited', 'modified') END AS is_human_overridden,
  CASE WHEN d IS NOT NULL THEN d IN ('accepted', 'edited', 'modified') END AS is_human_accepted,
  CASE WHEN d IS NOT NULL THEN dist END AS human_feedback_edit_distance, CASE WHEN d IS NOT NULL THEN cast(share AS double) END AS normalized_edit_distance,
  cast(CASE WHEN d = 'rejected' THEN -8 WHEN d = 'accepted' THEN 5 WHEN d IS NOT NULL THEN 0 END AS double) AS human_reward_score,
  cast(CASE WHEN d = 'rejected' THEN -8 WHEN d IN ('accepted', 'edited', 'modified') THEN
    CASE WHEN d = 'accepted' THEN 5 WHEN share <= 0.10 THEN 3 ELSE 0 END - CASE WHEN n_missed_critical > 0 THEN 10 ELSE 0 END
    - CASE WHEN findings_with_laterality > 0 AND laterality_accuracy_generated < 1 THEN 4 ELSE 0 END
    WHEN d IS NOT NULL THEN 0 END AS double) AS curator_reward_score
  FROM shares LEFT JOIN accuracy USING (request_id))"""

_READY = """ready AS (SELECT *, gen IS NOT NULL AND hum IS NOT NULL AS pair, gen IS NOT NULL AND hum IS NOT NULL AND prompt IS NOT NULL AS dpo,
  CASE WHEN reward >= 0.6 THEN 'good' WHEN reward >= 0 THEN 'acceptable' ELSE 'bad' END AS label FROM full_req)"""

_LATENCY = "CASE WHEN path = 0 OR o_orderkey % 100 = 0 THEN 7.5 ELSE o_orderkey % 100 END"
_TRIGGERED = "CASE path WHEN 1 THEN true WHEN 2 THEN false END"
_ALL = f"{_accuracy_sql()}, {_fields_sql()}, {_FEEDBACK}, {_READY}"
_OUTPUT = f"""output AS (SELECT r.request_id, tenant_id, site_id, 'DX' AS modality, 'CHEST' AS body_part, r.disposition,
  CASE WHEN send THEN prompt END AS prompt_text, send AND pair AS has_dpo_pair, send AND dpo AS is_dpo_ready,
  send AND dpo AND coalesce(f.disposition <> 'rejected', false) AS is_dpo_training_ready,
  CASE WHEN send THEN cast(reward AS double) END AS reward_score, CASE WHEN send THEN label END AS reward_label,
  is_human_overridden, is_human_accepted, human_feedback_edit_distance, normalized_edit_distance AS human_feedback_normalized_edit_distance,
  human_reward_score, curator_reward_score, clinical_accuracy_score, finding_recall_generated, false_negative_rate_generated, impression_agreement_score,
  laterality_error_rate, severity_error_rate, projection_error_rate, measurement_error_rate, overall_field_error_rate,
  CASE WHEN send THEN {_TRIGGERED} END AS reflector_triggered, CASE WHEN send THEN cast({_LATENCY} AS double) END AS agent_latency_ms,
  CASE WHEN send THEN 'draft-2' END AS generator_model_version
  FROM ready r LEFT JOIN feedback f USING (request_id) LEFT JOIN accuracy USING (request_id) LEFT JOIN fields USING (request_id))"""
_ROWS = f"{_ALL}, {_OUTPUT} SELECT {', '.join(_FLAT)} FROM output"
_SOURCE = "CASE WHEN gen IS NULL THEN NULL WHEN NOT nested THEN 'generated_impression' WHEN path < 2 THEN 'input_payload_json.generator_response.output.impression_text' ELSE 'input_payload_json.impression_text' END"


def _means(*columns: str) -> str:
    return ", ".join(f"{_even(f'(sum(cast(round({c} * 10000) AS bigint)) / (10000.0 * count({c}))::double)', 6)} AS mean_{c}" for c in columns)


_MEANS = _means("clinical_accuracy_score", "finding_recall_generated", "false_negative_rate_generated", "overall_field_error_rate", "curator_reward_score")

_JSON_LIST = lambda c: f"'[' || coalesce(string_agg('\"' || label || '\"', ',' ORDER BY pos) FILTER (WHERE {c}), '') || ']'"
_QUOTED = lambda c: f"cast(to_json({c}) AS varchar)"
_SENT = lambda c: f"CASE WHEN send THEN {c} END"
_DETAILS = f"""{_ALL}, {_OUTPUT}, lists AS (SELECT request_id, {_JSON_LIST("presence = 'present' AND NOT mentioned_in_generated")} AS missed_f,
  {_JSON_LIST("presence = 'present' AND is_critical AND NOT mentioned_in_generated")} AS missed_c,
  max(label) FILTER (WHERE pos = 1) AS first_label, bool_or(mentioned_in_human) FILTER (WHERE pos = 1) AS first_mentioned FROM checks GROUP BY 1)
SELECT r.request_id, cast(NULL AS varchar) AS event_id, 'PASS' AS decision, cast(NULL AS varchar) AS actual_route, cast(NULL AS varchar) AS expected_route,
  cast(NULL AS varchar) AS actual_scope_key, cast(NULL AS varchar) AS expected_scope_key, {_SENT("hum")} AS preferred_output, {_SENT("gen")} AS dispreferred_output,
  CASE WHEN NOT send THEN '["send_to_curator=False — row skipped"]' ELSE '[' || concat_ws(',', CASE WHEN gen IS NULL THEN '"generated_impression"' END, CASE WHEN hum IS NULL THEN '"human_impression"' END, CASE WHEN prompt IS NULL THEN '"prompt_text"' END) || ']' END AS missing_fields,
  cast(NULL AS double) AS latency_ms, send AND gen IS NOT NULL AS has_generated_output, send AND hum IS NOT NULL AS has_human_reference,
  a.finding_precision_generated, a.critical_finding_capture_rate_generated, a.laterality_accuracy_generated, a.severity_accuracy_generated,
  missed_f AS missed_findings_generated, missed_c AS missed_critical_generated, CASE WHEN l.request_id IS NOT NULL THEN '[]' END AS hallucinated_findings_generated,
  0::bigint AS total_tokens, 0::bigint AS prompt_tokens, 0::bigint AS completion_tokens, cast(NULL AS double) AS estimated_cost_usd,
  {_SENT("CASE o_orderkey % 5 WHEN 0 THEN 'reflect-1' WHEN 1 THEN 'reflect-2' END")} AS reflector_model_version, {_SENT("'python'")} AS clinical_accuracy_mode,
  {_SENT("CASE WHEN path = 3 THEN cast(o_orderkey % 50 AS double) END")} AS eval_latency_ms,
  CASE WHEN send AND dpo THEN '{{"prompt":' || {_QUOTED("prompt")} || ',"chosen":' || {_QUOTED("hum")} || ',"rejected":' || {_QUOTED("gen")} || '}}' END AS dpo_record,
  {_SENT("CASE WHEN o_orderkey % 3 = 0 THEN '2026-01-02 03:04:05' END")} AS submitted_to_queue_at, {_SENT("CASE WHEN o_orderkey % 4 = 0 THEN '2026-01-02 03:04:06' END")} AS human_approved_at,
  true AS has_created_at, a.finding_recall_human AS recall_human, a.total_findings_checked AS findings_checked, first_label, first_mentioned, fields.total_field_checks AS field_checks,
  f.disposition AS feedback_disposition, f.curator_reward_score AS feedback_reward, a.finding_recall_generated AS analytics_recall, fields.total_field_errors AS analytics_errors,
  NOT send AS response_skipped, {_SENT("CASE WHEN dpo THEN 'ready' ELSE 'incomplete' END")} AS response_status, CASE WHEN send AND dpo THEN prompt END AS response_prompt, send AND dpo AS response_ready
FROM ready r LEFT JOIN feedback f USING (request_id) LEFT JOIN accuracy a USING (request_id) LEFT JOIN fields USING (request_id) LEFT JOIN lists l USING (request_id)"""

ORACLES: dict[str, str] = {
    "output_rows": _ROWS,
    "output_details": _DETAILS,
    "streamed_output": _ROWS,
    "unrepeated_events": """
WITH e AS (SELECT *, epoch_us(ts) AS us, lag(epoch_us(ts)) OVER (PARTITION BY user_id, event_type ORDER BY ts) AS before FROM events WHERE ts IS NOT NULL),
runs AS (SELECT *, sum(CASE WHEN us <= before + 86400000000 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, event_type ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS run FROM e),
r AS (SELECT user_id, event_type, arg_min(event_id, (us, event_id)) AS event_id, arg_min(value, (us, event_id)) AS value, min(us) AS first_us, max(us) AS last_us, count(*) AS repeats FROM runs GROUP BY user_id, event_type, run)
SELECT event_id, user_id, event_type, value, first_us, last_us, repeats FROM r WHERE last_us + 86400000000 <= (SELECT max(us) FROM e) - 172800000000""",
    "event_lookup": f"{_GRADED} SELECT request_id, tenant_id, site_id, disposition, CASE WHEN NOT nested THEN gen END AS generated_impression, hum AS human_impression FROM full_req WHERE request_id = '1'",
    "event_lookups": f"{_GRADED} SELECT request_id, tenant_id, site_id, disposition, CASE WHEN NOT nested THEN gen END AS generated_impression, hum AS human_impression FROM full_req JOIN orders USING (o_orderkey) WHERE o_orderpriority = '1-URGENT'",
    "request_contracts": f"""WITH items AS ({ITEMS}), req AS ({REQUESTS}), place AS (SELECT *, 'inputs.observation_payload.structured_findings[' || (pos - 1) || '].' AS spot FROM items),
wrong AS (SELECT l_orderkey AS o, spot || 'label: missing' AS f FROM place WHERE gv = 7 UNION ALL SELECT l_orderkey, spot || 'presence: not a known value' FROM place WHERE hv = 6
  UNION ALL SELECT l_orderkey, spot || 'confidence: not within 0 and 1' FROM place WHERE hv = 5 UNION ALL SELECT o_orderkey, 'case.exam.modality: not a known value' FROM req WHERE o_orderkey % 5 = 0
  UNION ALL SELECT o_orderkey, 'case.exam.laterality: not a known value' FROM req WHERE o_orderkey % 9 = 0 UNION ALL SELECT o_orderkey, 'user.role: not a known value' FROM req WHERE o_orderkey % 7 = 0
  UNION ALL SELECT o_orderkey, 'case.accession_number: missing' FROM req WHERE o_orderkey % 8 = 0 UNION ALL SELECT o_orderkey, 'case.clinical_indication: not a text' FROM req WHERE o_orderkey % 11 = 0
  UNION ALL SELECT o_orderkey, 'ace_context: missing' FROM req WHERE o_orderkey % 10 = 0 UNION ALL SELECT o_orderkey, 'retrieval.top_k: not a whole number' FROM req WHERE o_orderkey % 6 = 0),
faults AS (SELECT o, count(*) AS n, string_agg(f, '; ' ORDER BY f) AS f FROM wrong GROUP BY 1), counts AS (SELECT l_orderkey, count(*) AS n FROM items GROUP BY 1)
SELECT request_id, coalesce(faults.n, 0) AS n_faults, coalesce(f, '') AS faults, CASE WHEN o_orderkey % 6 <> 0 THEN 3::bigint END AS top_k, true AS enabled, 'U' AS sex,
  CASE WHEN o_orderkey % 10 <> 0 THEN 'radiology' END AS profile, coalesce(counts.n, 0) AS n_findings FROM req LEFT JOIN faults ON o = o_orderkey LEFT JOIN counts ON l_orderkey = o_orderkey""",
    "payload_extraction": f"""{_GRADED} SELECT request_id, gen AS generated, {_SOURCE} AS generator_output_source, coalesce({_SOURCE} <> 'generated_impression', false) AS fallback_used,
  prompt AS prompt_text, projection, 'draft-2' AS generator_model_version, cast({_LATENCY} AS double) AS agent_latency_ms, cast(reward AS double) AS reward_score,
  {_TRIGGERED} AS reflector_triggered, CASE WHEN path = 1 THEN 'BAD_ROUTE' ELSE '' END AS issue_codes, n AS n_findings FROM full_req""",
    "event_properties": "SELECT event_id, cast(json_extract_string(props, '$.k') AS double) AS k FROM events",
    "readiness_scores": f"""{_GRADED}, {_READY} SELECT request_id, NOT send AS skipped, send AND prompt IS NOT NULL AS has_prompt, send AND pair AS has_dpo_pair, send AND dpo AS is_dpo_ready,
  CASE WHEN NOT send THEN 'send_to_curator=False — row skipped' ELSE concat_ws(',', CASE WHEN gen IS NULL THEN 'generated_impression' END, CASE WHEN hum IS NULL THEN 'human_impression' END, CASE WHEN prompt IS NULL THEN 'prompt_text' END) END AS missing_fields,
  cast(CASE WHEN send THEN round_even((2 + cast(gen IS NOT NULL AS int) + cast(hum IS NOT NULL AS int) + cast(prompt IS NOT NULL AS int)) / 5.0, 4) ELSE 0 END AS double) AS data_completeness_score,
  cast(send AND dpo AS double) AS dpo_readiness_score, CASE WHEN send THEN label END AS reward_label FROM ready""",
    "document_sentences": rf"""WITH t AS (SELECT doc_id, regexp_replace(lower(regexp_replace(regexp_replace(coalesce(text, ''), '^\s+', ''), '\s+$', '')), '\s+', ' ', 'g') AS t FROM documents),
pieces AS (SELECT doc_id, unnest(string_split(regexp_replace(t, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))) AS s FROM t),
bare AS (SELECT doc_id, trim(regexp_replace(trim(s), '^\d+\.\s*', '')) AS s FROM pieces),
n AS (SELECT doc_id, count(*) AS n_sentences, count(*) FILTER (WHERE {_NEGATED}) AS n_negated, sum(length(s)) AS n_chars FROM bare WHERE s <> '' GROUP BY 1)
SELECT d.doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(n_negated, 0) AS n_negated, cast(coalesce(n.n_chars, 0) AS bigint) AS n_chars FROM documents d LEFT JOIN n USING (doc_id)""",
    "finding_checks": f"""{_GRADED} SELECT request_id, pos, label, presence, severity, location, mentioned_in_generated, mentioned_in_human, laterality_match_generated, laterality_match_human,
  severity_match_generated, severity_match_human, is_critical, presence = 'present' AND is_critical AND mentioned_in_generated AS critical_captured_generated,
  presence = 'present' AND is_critical AND mentioned_in_human AS critical_captured_human FROM checks""",
    "clinical_accuracy": f"{_accuracy_sql()} SELECT request_id, {', '.join([*_ACCURACY, *_COUNTS])}, missed FROM accuracy",
    "field_performance": f"{_GRADED}, {_fields_sql()} SELECT * FROM fields",
    "feedback_rewards": f"{_accuracy_sql()}, {_FEEDBACK} SELECT * FROM feedback",
    "training_export": f"{_ALL}, {_OUTPUT} SELECT prompt_text AS prompt, hum AS chosen, gen AS rejected FROM output JOIN full_req USING (request_id) WHERE is_dpo_training_ready",
    "tenant_rollup": f"""{_ALL}, {_OUTPUT} SELECT tenant_id, disposition, count(*) AS requests, count(*) FILTER (WHERE has_dpo_pair) AS with_pair, count(*) FILTER (WHERE is_dpo_ready) AS dpo_ready,
  count(*) FILTER (WHERE is_dpo_training_ready) AS training_ready, {_MEANS} FROM output GROUP BY 1, 2""",
    "dashboard": f"""{_ALL}, {_OUTPUT} SELECT concat_ws(',', CASE WHEN grouping(tenant_id) = 0 THEN 'tenant_id' END, CASE WHEN grouping(disposition) = 0 THEN 'disposition' END,
  CASE WHEN grouping(generator_model_version) = 0 THEN 'generator_model_version' END, CASE WHEN grouping(body_part) = 0 THEN 'body_part' END) AS level,
  tenant_id, body_part, disposition, generator_model_version, count(*) AS requests, count(*) FILTER (WHERE has_dpo_pair) AS with_pair, count(*) FILTER (WHERE is_dpo_ready) AS dpo_ready,
  count(*) FILTER (WHERE is_dpo_training_ready) AS training_ready, count(*) FILTER (WHERE is_human_overridden) AS overridden, {_means("clinical_accuracy_score", "finding_recall_generated", "overall_field_error_rate", "curator_reward_score")}
  FROM output GROUP BY GROUPING SETS ((), (tenant_id), (disposition, generator_model_version), (tenant_id, body_part, disposition))""",
    "traced_batches": f"""{_GRADED}, {_READY}, c AS (SELECT count(*) AS n, count(*) FILTER (WHERE NOT send) AS skipped, count(*) FILTER (WHERE send AND dpo) AS ready, count(*) FILTER (WHERE send AND gen IS NULL) AS no_gen,
  count(*) FILTER (WHERE send AND hum IS NULL) AS no_hum, count(*) FILTER (WHERE send AND prompt IS NULL) AS no_prompt FROM ready)
SELECT 'counts' AS kind, unnest(['rows', 'skipped', 'dpo_ready', 'missing_generated_impression', 'missing_human_impression', 'missing_prompt_text']) AS count,
  unnest([n, skipped, ready, no_gen, no_hum, no_prompt]) AS value FROM c
UNION ALL SELECT 'progress', 'input_rows', n FROM c UNION ALL SELECT 'stage', 'rows', n FROM c""",
    "quarantine_replay": """
WITH k AS (SELECT cast(o_orderkey AS varchar) AS request_id, o_orderkey % 13 = 0 AS mended, o_orderkey % 17 = 0 AS listed, o_orderkey % 19 = 0 AS cut FROM orders)
SELECT request_id, CASE WHEN NOT mended AND (listed OR cut) THEN 'waiting' ELSE 'good' END AS place,
  CASE WHEN mended THEN NULL WHEN listed THEN 'payload is not an object' WHEN cut THEN 'payload is not JSON' END AS fault,
  CASE WHEN mended OR listed OR cut THEN 1::bigint ELSE 0::bigint END AS tries, CASE WHEN mended OR NOT (listed OR cut) THEN 'DX' END AS modality FROM k""",
    "judge_accuracy": _judge_sql(),
    "judge_accuracy_by_join": _judge_sql(),
    "judge_answers": f"""{_GRADED} SELECT request_id, pos, 'finding_' || pos AS finding_id, label, contains(lower(coalesce(full_req.gen, '')), lower(label)) AS in_generated,
  contains(lower(coalesce(full_req.hum, '')), lower(label)) AS in_human, n AS prompt_tokens, 0::bigint AS asked_again FROM full_req JOIN items ON l_orderkey = o_orderkey WHERE graded""",
    "label_rollup": f"""{_GRADED} SELECT label, count(*) AS checks, count(*) FILTER (WHERE presence = 'present') AS present, count(*) FILTER (WHERE presence = 'present' AND mentioned_in_generated) AS found_by_generated,
  count(*) FILTER (WHERE presence = 'present' AND mentioned_in_human) AS found_by_human, count(*) FILTER (WHERE NOT laterality_match_generated) AS wrong_side_generated,
  count(*) FILTER (WHERE NOT severity_match_generated) AS wrong_grade_generated FROM checks GROUP BY 1""",
}

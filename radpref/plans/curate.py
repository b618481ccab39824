"""From review events to graded preference rows: one map-only plan for batches and streams.

:func:`curate` gives one response for each event; :func:`flatten` makes the wide output row of it. Skipped
events are kept, with empty metrics.
"""

from __future__ import annotations

import os
from collections.abc import Collection
from dataclasses import dataclass, field, replace
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from radpref.functions import variants as V
from radpref.operators.clinical import clinical_accuracy, with_sentences
from radpref.operators.extract import extract, findings, parse_payload
from radpref.operators.feedback import SKIP_NOTE, estimated_cost, human_feedback, readiness, reward_label, with_disposition
from radpref.operators.fields import field_performance
from radpref.operators.judge import judged_accuracy, last_answers
from radpref.schemas import EVENT, OUTPUT_COLUMNS, to_events
from radpref.sources.events import fetch

_JSON = {"ignoreNullFields": "false"}


@dataclass(frozen=True)
class Settings:
    """``mode``: "python" grades by rules, "llm" by stored judge answers. ``strict``: bad events fail the job instead of being marked.

    ``source`` and ``sink``: a path or the name of a table each. ``project`` and ``api_key`` are what a judge's provider needs.
    """

    mode: str = "python"
    provider: str = "vertexai"
    strict: bool = False
    model: str | None = None
    project: str | None = None
    location: str = "us-central1"
    api_key: str | None = field(default=None, repr=False)
    source: str | None = None
    sink: str | None = None
    app_name: str = "radpref"
    environment: str = "development"

    @staticmethod
    def from_env() -> Settings:
        get = os.environ.get
        return Settings(
            mode=get("CLINICAL_ACCURACY_MODE", "python").strip().lower(),
            provider=get("LLM_PROVIDER", "vertexai").strip().lower(),
            model=get("LLM_MODEL_NAME", "").strip() or None,
            project=get("GOOGLE_CLOUD_PROJECT"),
            location=get("GOOGLE_CLOUD_LOCATION", "us-central1"),
            api_key=get("GOOGLE_API_KEY"),
            source=get("RADPREF_SOURCE"),
            sink=get("RADPREF_SINK"),
            app_name=get("APP_NAME", "radpref"),
            environment=get("ENV", "development"),
        )


def held(df: DataFrame, *passed: str, only: Collection[str] = ()) -> DataFrame:
    """``df`` with all columns but ``passed``, or those of ``only`` if any are named, worked out here, once a row, as the one element of an array that is taken apart again.

    A filter on a metric is then tested on the metric, not on copies of all the formulas that lead to it.
    One on passed columns still reaches the scan.
    """
    return df.select(*passed, F.inline(F.array(F.struct(*[c for c in df.columns if c not in passed and (not only or c in only)]))))


def prepare(events: DataFrame, *only: str) -> DataFrame:
    """Events with everything extracted and split that grading needs; or next to their own columns just those of ``only``, and nothing worked out but for these."""
    events = to_events(events)
    return held(with_sentences(findings(extract(held(parse_payload(events), *events.columns)))), *events.columns, only=only)


def grade(prepared: DataFrame, settings: Settings = Settings(), answers: DataFrame | None = None) -> DataFrame:
    """Prepared events with all metric structs, readiness and scores."""
    if settings.mode == "llm":
        if answers is None:
            raise ValueError("mode llm needs the judge's stored answers")
        out = judged_accuracy(prepared, answers)
    else:
        zero = F.lit(0).cast("long")
        out = clinical_accuracy(prepared).withColumns({f"judge_{k}": zero for k in ("prompt_tokens", "completion_tokens", "total_tokens")}).withColumn("judge_failed", F.lit(None).cast("string"))
    return readiness(human_feedback(field_performance(out)))


METRICS = ("clinical_accuracy", "field_performance", "human_feedback")
#: What a response holds of a prepared event beside its metrics.
_EXTRACTED = (
    "payload_failed", "is_skipped", "generated", "generator_output_source", "case", "inputs", "reward_score", "reward_reason", "send_to_curator", "issue_codes", "prompt_text",
    "generator_model_version", "reflector_model_version", "reflector_triggered", "submitted_to_queue_at", "human_approved_at", "modality", "body_part", "fallback_used",
    "findings_text", "agent_latency_ms", "eval_latency_ms",
)


@lru_cache(1)
def _empty_metrics() -> dict[str, str]:
    """The types of what is null without metrics, by name."""
    graded = grade(prepare(SparkSession.active().createDataFrame([], EVENT)))
    return {c: graded.schema[c].dataType.simpleString() for c in (*METRICS, "field_error", "judge_failed")}


def _ungraded(events: DataFrame) -> DataFrame:
    """As :func:`grade` of prepared events, with all metrics null: nothing is worked out that only they ask for."""
    bare = prepare(events, *_EXTRACTED)
    none = {c: F.lit(None).cast(kind) for c, kind in _empty_metrics().items()}
    zero = {f"judge_{k}": F.lit(0).cast("long") for k in ("prompt_tokens", "completion_tokens", "total_tokens")}
    return readiness(with_disposition(bare.withColumns(none | zero)))


def curate(events: DataFrame, settings: Settings = Settings(), answers: DataFrame | None = None, metrics: bool = True) -> DataFrame:
    """One row an event: its columns, ``response`` (struct), ``modality``, ``body_part`` and ``error``.

    ``error`` is null unless the payload isn't JSON, a size can't be compared, or a judgment is missing;
    in strict mode the latter two fail the job. Without ``metrics`` their structs, and errors in them, are null.
    """
    g = grade(prepare(events), settings, answers) if metrics else _ungraded(events)
    skipped = F.col("is_skipped")
    unless_skipped = lambda c: F.when(~skipped, c)
    none = F.lit(None).cast("string")
    exam = V.at(F.col("case"), "exam")
    label = reward_label(F.col("reward_score"))
    ready = F.col("readiness.is_dpo_ready")
    example = F.struct(
        F.struct(
            F.col("request_id"),
            V.text_at(exam, "modality").alias("modality"),
            V.text_at(exam, "body_part").alias("body_part"),
            V.text_at(exam, "procedure_code").alias("procedure_code"),
            F.col("actual_scope_key").alias("scope_key"),
            V.text_at(F.col("case"), "clinical_indication").alias("clinical_indication"),
            V.text_at(F.col("case"), "history").alias("history"),
            F.col("findings_text"),
            V.at(F.col("inputs"), "observation_payload.structured_findings").alias("structured_findings"),
            F.col("prompt_text"),
        ).alias("prompt_input"),
        F.col("human_impression").alias("preferred_output"),
        F.col("generated").alias("dispreferred_output"),
        F.struct("tenant_id", "site_id", "decision", "reward_score", label.alias("reward_label"), "issue_codes", "actual_route", F.col("actual_scope_key").alias("scope_key")).alias("metadata"),
    )
    d = F.col("disposed")
    no = F.lit(False)
    zero = F.lit(0).cast("long")
    kept = lambda c, default: F.when(skipped, default).otherwise(c)
    analytics = F.struct(
        kept(F.col("readiness.has_generated_output"), no).alias("has_generated_output"),
        kept(F.col("readiness.has_human_output"), no).alias("has_human_reference"),
        kept(ready & F.coalesce(d != "rejected", no), no).alias("is_dpo_training_ready"),
        unless_skipped(F.col("clinical_accuracy")).alias("clinical_accuracy"),
        unless_skipped(F.col("human_feedback")).alias("human_feedback"),
        unless_skipped(F.col("field_performance")).alias("field_performance"),
        *[kept(F.col(f"judge_{k}"), zero).alias(k) for k in ("total_tokens", "prompt_tokens", "completion_tokens")],
        unless_skipped(estimated_cost(F.col("judge_prompt_tokens"), F.col("judge_completion_tokens"), settings.provider)).alias("estimated_cost_usd"),
        unless_skipped(F.col("generator_model_version")).alias("generator_model_version"),
        unless_skipped(F.col("reflector_model_version")).alias("reflector_model_version"),
        unless_skipped(F.lit(settings.mode)).alias("clinical_accuracy_mode"),
        *[unless_skipped(F.col(k)).alias(k) for k in ("reflector_triggered", "agent_latency_ms", "eval_latency_ms", "submitted_to_queue_at", "human_approved_at")],
    )
    empty_ready = F.struct(*[no.alias(k) for k in ("has_prompt", "has_generated_output", "has_human_output", "has_dpo_pair", "is_dpo_ready")], F.array(F.lit(SKIP_NOTE)).alias("missing_fields"))
    half = F.lit(0.0)
    response = F.struct(
        "request_id",
        "tenant_id",
        "decision",
        F.struct(unless_skipped(F.col("generated")).alias("generated_impression"), unless_skipped(F.col("final_impression")).alias("final_impression"), unless_skipped(F.col("human_impression")).alias("human_impression")).alias("impressions"),
        unless_skipped(F.col("reward_score")).alias("reward_score"),
        unless_skipped(label).alias("reward_label"),
        unless_skipped(F.col("reward_reason")).alias("reward_reason"),
        kept(F.col("issue_codes"), F.array().cast("array<string>")).alias("issue_codes"),
        unless_skipped(F.col("prompt_text")).alias("prompt_text"),
        F.struct(*[kept(F.col(f"scores.{k}"), half).alias(k) for k in ("data_completeness_score", "prompt_completeness_score", "dpo_readiness_score")]).alias("scores"),
        analytics.alias("analytics"),
        F.when(~skipped & ready, example).alias("training_example"),
        kept(F.col("readiness"), empty_ready).alias("readiness"),
        F.when(~skipped, F.struct("actual_route", "expected_route", "actual_scope_key", "expected_scope_key", "reward_reason", "send_to_curator")).alias("provenance"),
        F.struct(
            skipped.alias("skipped"),
            F.when(skipped, "send_to_curator=False").alias("skip_reason"),
            F.lit(None).cast("double").alias("latency_ms"),
            unless_skipped(F.when(ready, "ready").otherwise("incomplete")).alias("status"),
            unless_skipped(ready).alias("has_training_example"),
            unless_skipped(F.col("generator_output_source")).alias("generator_output_source"),
            unless_skipped(F.col("fallback_used")).alias("fallback_used"),
        ).alias("trace"),
    )
    wrong = unless_skipped(F.coalesce("judge_failed", "field_error"))
    error = F.coalesce(F.when(F.col("payload_failed"), "payload is not JSON"), wrong)
    if settings.strict:
        error = F.when(wrong.isNotNull(), F.raise_error(wrong).cast("string")).otherwise(error)
    keep = ["request_id", "event_id", "tenant_id", "site_id", "decision", "disposition", "actual_route", "expected_route", "actual_scope_key", "expected_scope_key", "modality", "body_part"]
    event = [c for c in keep if c not in ("modality", "body_part")]
    return held(g.select(*keep, response.alias("response"), F.coalesce(error, none).alias("error")), *event)


class NotFoundError(LookupError):
    """No event of the request."""


def curate_one(events: DataFrame, request_id: str, settings: Settings = Settings(), answers: DataFrame | None = None) -> DataFrame:
    """The response to one request, by key: one row of :func:`curate`, for the event as it was fetched here, and its last answer likewise.

    The source is read once; whatever is done with the row, it is of the event whose error was looked at.
    Without an event of that key :class:`NotFoundError`; an event that can't be curated comes back with its
    ``error``, or fails with :class:`ValueError` in strict mode.
    """
    spark = events.sparkSession
    event = fetch(events, request_id).first()
    if event is None:
        raise NotFoundError(f"no event of request {request_id}")
    if answers is not None:
        own = last_answers(answers.where(F.col("request_id") == request_id))
        answers = spark.createDataFrame(own.collect(), own.schema)
    out = curate(spark.createDataFrame([event], EVENT), replace(settings, strict=False), answers)
    if settings.strict and (error := out.select("error").first()["error"]):
        raise ValueError(error)
    return out


def flatten(curated: DataFrame, created_at: Column | None = None) -> DataFrame:
    """The wide output row: scalars as columns, nested parts as JSON text, nulls spelt out."""
    r = F.col("response")
    a = r["analytics"]
    ca, hf, fp = a["clinical_accuracy"], a["human_feedback"], a["field_performance"]
    text = lambda c: F.when(c.isNotNull(), F.to_json(c, _JSON))
    ex = r["training_example"]
    record = F.struct(ex["prompt_input"]["prompt_text"].alias("prompt"), ex["preferred_output"].alias("chosen"), ex["dispreferred_output"].alias("rejected"))
    stamp = lambda c: F.coalesce(c.try_cast("timestamp"), F.regexp_replace(c, " UTC$", "").try_cast("timestamp"))
    special = {
        "created_at": created_at if created_at is not None else F.current_timestamp(),
        "prompt_text": r["prompt_text"],
        "preferred_output": r["impressions"]["human_impression"],
        "dispreferred_output": r["impressions"]["generated_impression"],
        "has_dpo_pair": r["readiness"]["has_dpo_pair"],
        "is_dpo_ready": r["readiness"]["is_dpo_ready"],
        "missing_fields": text(r["readiness"]["missing_fields"]),
        "reward_score": r["reward_score"],
        "reward_label": r["reward_label"],
        "latency_ms": r["trace"]["latency_ms"],
        "analytics_json": text(a),
        "human_feedback_normalized_edit_distance": hf["normalized_edit_distance"],
        "human_feedback_json": text(hf),
        "clinical_accuracy_json": text(ca),
        "finding_checks_json": text(ca["finding_checks"]),
        "field_performance_json": text(fp),
        "submitted_to_queue_at": stamp(a["submitted_to_queue_at"]),
        "human_approved_at": stamp(a["human_approved_at"]),
        "dpo_record": F.when(ex.isNotNull(), F.to_json(record, _JSON)),
        "curator_response": text(r),
    }
    special |= {k: text(ca[k]) for k in ("missed_findings_generated", "missed_critical_generated", "hallucinated_findings_generated")}
    special |= {k: hf[k] for k in ("is_human_overridden", "is_human_accepted", "human_feedback_edit_distance", "human_reward_score", "curator_reward_score")}
    special |= {k: ca[k] for k in OUTPUT_COLUMNS if k.startswith(("finding_recall", "finding_precision", "false_negative", "critical_finding_capture", "laterality_accuracy", "severity_accuracy", "impression_agreement", "clinical_accuracy_score"))}
    special |= {k: fp[k] for k in OUTPUT_COLUMNS if k.endswith("_error_rate")}
    special |= {k: a[k] for k in OUTPUT_COLUMNS if k not in special and k not in curated.columns}
    return curated.select(*[special.get(k, F.col(k)).alias(k) for k in OUTPUT_COLUMNS])


def latest(output: DataFrame) -> DataFrame:
    """Of rows that repeat a request the newest. An extension: the table itself is append-only."""
    top = output.groupBy("request_id").agg(F.max_by(F.struct(*[c for c in output.columns if c != "request_id"]), "created_at").alias("row"))
    return top.select("request_id", "row.*").select(output.columns)

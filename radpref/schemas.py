"""Fixed schemas: input events, judge evaluations, and the order of the output table's columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A review event. The two JSON columns hold text; it may be JSON once or twice over.
EVENT_COLUMNS = (
    "request_id",
    "event_id",
    "tenant_id",
    "site_id",
    "decision",
    "disposition",
    "expected_route",
    "actual_route",
    "expected_scope_key",
    "actual_scope_key",
    "impression_text",
    "generated_impression",
    "final_impression",
    "human_impression",
    "issues_json",
    "input_payload_json",
    "has_embedding",
)
EVENT = T.StructType([T.StructField(c, T.BooleanType() if c == "has_embedding" else T.StringType(), c != "request_id") for c in EVENT_COLUMNS])

_SIDE = "struct<mention_status: string, laterality_applicable: boolean, laterality_correct: boolean, severity_applicable: boolean, severity_correct: boolean, critical_captured: boolean, evidence: string>"
_UNSUPPORTED = "array<struct<label: string, location: string, severity: string, evidence: string, confidence: string>>"
#: What a judge returns for one event.
EVALUATION = f"""finding_judgments array<struct<finding_id: string, label: string, presence: string, normalized_finding_type: string,
  is_critical: boolean, generated: {_SIDE}, human: {_SIDE}, reasoning: string>>,
  hallucinated_findings_generated {_UNSUPPORTED}, hallucinated_findings_human {_UNSUPPORTED},
  agreement_common_finding_ids array<string>, agreement_generated_only_finding_ids array<string>,
  agreement_human_only_finding_ids array<string>, reasoning string"""

#: The output table, in order.
OUTPUT_COLUMNS = tuple(
    """request_id created_at event_id tenant_id site_id modality body_part decision disposition actual_route expected_route
    actual_scope_key expected_scope_key prompt_text preferred_output dispreferred_output has_dpo_pair is_dpo_ready missing_fields
    reward_score reward_label latency_ms has_generated_output has_human_reference is_dpo_training_ready analytics_json
    is_human_overridden is_human_accepted human_feedback_edit_distance human_feedback_normalized_edit_distance human_reward_score
    curator_reward_score human_feedback_json clinical_accuracy_json clinical_accuracy_score finding_recall_generated
    finding_precision_generated false_negative_rate_generated critical_finding_capture_rate_generated
    laterality_accuracy_generated severity_accuracy_generated impression_agreement_score missed_findings_generated
    missed_critical_generated finding_checks_json hallucinated_findings_generated field_performance_json laterality_error_rate
    severity_error_rate projection_error_rate measurement_error_rate overall_field_error_rate total_tokens prompt_tokens
    completion_tokens estimated_cost_usd generator_model_version reflector_model_version clinical_accuracy_mode
    reflector_triggered agent_latency_ms eval_latency_ms submitted_to_queue_at human_approved_at dpo_record
    curator_response""".split()
)

#: The upstream request that payloads come from, for fixtures and checks; nothing else depends on it.
EXAM = "struct<modality: string, body_part: string, procedure_code: string, laterality: string, projection: string>"
FINDING = "struct<label: string, presence: string, severity: string, location: string, confidence: double, measurements: map<string, double>, evidence: map<string, string>>"
REQUEST = f"""request_id string, tenant_id string, site_id string,
  case struct<accession_number: string, study_instance_uid: string, exam: {EXAM}, clinical_indication: string, history: string>,
  inputs struct<source_text: struct<findings_text: string, draft_impression_text: string>,
    observation_payload: struct<structured_findings: array<{FINDING}>>, attached_docs: array<struct<type: string, text: string>>>"""


PRESENCES = ("present", "absent", "uncertain")
MODALITIES = ("CR", "DX", "CT", "MR", "US", "NM", "MG", "XA", "OT")
LATERALITIES = ("L", "R", "B", "U")


def request_faults(request: Column) -> Column:
    """What is wrong with a request struct of type ``REQUEST``: an array of words, empty if nothing is."""
    wrong = lambda value, allowed: value.isNotNull() & ~value.isin(*allowed)
    found = request["inputs"]["observation_payload"]["structured_findings"]
    some = lambda keep: F.coalesce(F.exists(found, keep), F.lit(False))
    exam = request["case"]["exam"]
    tests = {
        "no request_id": F.coalesce(request["request_id"], F.lit("")) == "",
        "no accession_number": request["case"].isNotNull() & request["case"]["accession_number"].isNull(),
        "unknown modality": wrong(exam["modality"], MODALITIES),
        "unknown laterality": wrong(exam["laterality"], LATERALITIES),
        "finding without label": some(lambda f: f["label"].isNull()),
        "unknown presence": some(lambda f: f["presence"].isNull() | ~f["presence"].isin(*PRESENCES)),
        "confidence not within 0 and 1": some(lambda f: F.coalesce(~f["confidence"].between(0.0, 1.0), F.lit(False))),
    }
    return F.filter(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(k)) for k, t in tests.items()]), lambda x: x.isNotNull())


def is_event(df: DataFrame) -> bool:
    return set(EVENT_COLUMNS) <= set(df.columns)


def to_events(df: DataFrame) -> DataFrame:
    """Any frame as events: other columns dropped, missing ones null, nested JSON columns turned to text."""
    kinds = dict(df.dtypes)

    def one(name: str) -> Column:
        if name not in kinds:
            return F.lit(None).cast(EVENT[name].dataType).alias(name)
        c = F.col(name)
        if kinds[name] == "variant" or kinds[name].startswith(("struct", "array", "map")):
            c = F.to_json(c)
        return (c.try_cast("boolean") if name == "has_embedding" else c.cast("string")).alias(name)

    return df.select(*map(one, EVENT_COLUMNS))

"""Contracts: faults by path, defaults, and types that agree with the typed values."""

import json

import pytest
from pyspark.sql import functions as F

from radpref.contracts import CONTRACTS, faults, struct_type, typed

GOOD = {
    "tenant_id": "t", "request_id": "r", "user": {"user_id": "u", "role": "system"},
    "case": {"accession_number": "a", "patient": {"patient_id": "p", "sex": None}, "exam": {"modality": "CT", "body_part": "HEAD"}, "clinical_indication": ""},
    "inputs": {"observation_payload": {}}, "ace_context": {"playbook_id": "p", "playbook_version": "1", "style_guide": {}}, "constraints": {},
}


def check(spark, contract, *values):
    texts = [(i, v if isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    rows = spark.createDataFrame(texts, "i int, t string").select("i", F.try_parse_json("t").alias("v")).select("i", faults(F.col("v"), contract).alias("f"))
    return [r["f"] for r in rows.orderBy("i").collect()]


def test_faults(spark):
    bad = json.loads(json.dumps(GOOD))
    del bad["tenant_id"]
    bad["request_id"], bad["user"] = None, "u"
    bad["case"]["exam"]["laterality"] = "left"
    bad["inputs"] = {"observation_payload": {"structured_findings": [{"label": "x", "presence": "present", "confidence": "0.5"}, 3, {"label": 4, "presence": "?", "confidence": -1, "evidence": []}], "critical_flags": ["a", None, 1]}, "attached_docs": {}}
    bad["retrieval"] = {"enabled": None, "top_k": 2.5}
    bad["model"] = {"temperature": "hot", "max_tokens": 3.0}
    at = "inputs.observation_payload."
    want = [
        "tenant_id: missing", "request_id: null", "user: not an object", "case.exam.laterality: not a known value", at + "structured_findings[1]: not an object",
        at + "structured_findings[2].label: not a text", at + "structured_findings[2].presence: not a known value", at + "structured_findings[2].confidence: not within 0 and 1", at + "structured_findings[2].evidence: not an object",
        at + "critical_flags[1]: null", at + "critical_flags[2]: not a text", "inputs.attached_docs: not a list", "retrieval.enabled: null", "retrieval.top_k: not a whole number", "model.temperature: not a number",
    ]
    assert check(spark, "request", GOOD, bad, "[]", "?", "null") == [[], want, *[["not an object"]] * 3]
    assert check(spark, "check", {"check": "c", "passed": "yes"}, {"check": "c", "passed": 1}, {"check": "c", "passed": 2}) == [[], [], ["passed: not a truth value"]]
    assert check(spark, "answer", {"request_id": "r", **{k: {} for k in ("case_ref", "output", "provenance", "trace", "quality")}}, {"request_id": "r", "output": []})[0] == []


@pytest.mark.parametrize("contract", list(CONTRACTS))
def test_types_agree(spark, contract):
    out = spark.range(1).select(typed(F.try_parse_json(F.lit("{}")), contract).alias("t"))
    plain = lambda t: t.simpleString()
    assert plain(out.schema["t"].dataType) == plain(struct_type(contract))


def test_defaults(spark):
    t = spark.range(1).select(typed(F.parse_json(F.lit(json.dumps(GOOD))), "request").alias("t")).select("t.case.patient.sex", "t.ace_context.style_guide.tone", "t.ace_context.specialty_profile", "t.inputs.observation_payload.structured_findings", "t.constraints.avoid_phi_in_output", "t.retrieval").first()
    assert tuple(t) == (None, "concise", "radiology", [], True, None)

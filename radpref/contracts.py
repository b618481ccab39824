"""What upstream requests and answers must look like: tables of fields, compiled into types, typed values and one column of faults."""

from __future__ import annotations

from typing import Any, NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from radpref.functions import variants as V


class Field(NamedTuple):
    """``kind``: a scalar type, ``object`` (any object), or the name of a contract; ``many``: a list of it. ``low`` and ``high`` are allowed."""

    kind: str
    required: bool = True
    nullable: bool = False
    default: Any = None
    allowed: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    many: bool = False


def need(kind: str = "string", **more: Any) -> Field:
    return Field(kind, **more)


def may(kind: str = "string", default: Any = None, **more: Any) -> Field:
    """A field that may be missing or null."""
    return Field(kind, required=False, nullable=True, default=default, **more)


def preset(kind: str, default: Any = None, **more: Any) -> Field:
    """A field that may be missing but not null."""
    return Field(kind, required=False, default=default, **more)


def texts() -> Field:
    return may(many=True)


# Fields, enumerations, ranges and defaults of the messages.
CONTRACTS: dict[str, dict[str, Field]] = {
    "user": {"user_id": need(), "role": need(allowed=("radiologist", "clinician", "resident", "ai_qc", "system")), "department": may()},
    "patient": {"patient_id": need(), "age": may(), "sex": may(default="U", allowed=("M", "F", "O", "U"))},
    "exam": {"modality": need(allowed=("CR", "DX", "CT", "MR", "US", "NM", "MG", "XA", "OT")), "body_part": need(), "procedure_code": may(), "laterality": may(allowed=("L", "R", "B", "U"))},
    "comparison": {"prior_study_uids": texts(), "prior_report_text": may(), "prior_key_findings": may("object")},
    "case": {"accession_number": need(), "study_instance_uid": may(), "patient": need("patient"), "exam": need("exam"), "clinical_indication": need(), "history": may(), "comparison": may("comparison")},
    "finding": {"label": need(), "presence": need(allowed=("present", "absent", "uncertain")), "severity": may(), "location": may(), "confidence": may("double", low=0.0, high=1.0), "measurements": may("object"), "evidence": may("object")},
    "observations": {"structured_findings": preset("finding", many=True), "key_measurements": may("object"), "critical_flags": texts()},
    "source_text": {"findings_text": may(), "draft_impression_text": may()},
    "attached_doc": {"type": need(allowed=("order", "clinical_note", "discharge_summary", "lab", "ecg", "pathology")), "text": may(), "doc_id": may()},
    "inputs": {"observation_payload": need("observations"), "source_text": may("source_text"), "attached_docs": may("attached_doc", many=True)},
    "style": {"tone": may(default="concise", allowed=("concise", "standard", "detailed")), "format": may(default="numbered", allowed=("bullets", "paragraph", "numbered")), "language": may(default="en-US"), "institutional_phrasing": may()},
    "playbook": {"playbook_id": need(), "playbook_version": need(), "specialty_profile": may(default="radiology"), "style_guide": may("style")},
    "retrieval_filters": {"modality": may(), "body_part": may(), "vendor_algo": may(), "guideline_set": texts()},
    "retrieval": {"enabled": preset("boolean", True), "top_k": preset("long", 2), "filters": may("retrieval_filters"), "vector_namespace": may()},
    "critical_policy": {"escalate_if": texts(), "escalation_text": may()},
    "constraints": {"no_diagnosis_beyond_evidence": preset("boolean", True), "avoid_phi_in_output": preset("boolean", True), "must_include": texts(), "must_not_include": texts(), "critical_result_policy": may("critical_policy")},
    "model": {"provider": may(default="vertex"), "model_name": may(), "temperature": may("double"), "max_tokens": may("long")},
    "request": {"tenant_id": need(), "site_id": may(), "request_id": need(), "user": need("user"), "case": need("case"), "inputs": need("inputs"), "ace_context": need("playbook"), "retrieval": may("retrieval"), "constraints": may("constraints"), "model": may("model")},
    "impression": {k: preset("string", many=True) for k in ("diagnoses", "differentials", "recommendations", "follow_up")},
    "check": {"check": need(), "passed": need("boolean"), "details": may()},
    "answer": {"request_id": need(), **{k: need("object") for k in ("case_ref", "output", "provenance", "trace", "quality")}},
}

_SCALARS = {"string": T.StringType(), "double": T.DoubleType(), "long": T.LongType(), "boolean": T.BooleanType(), "object": T.VariantType()}
_NAMES = {"string": "text", "double": "number", "long": "whole number", "boolean": "truth value"}


def struct_type(contract: str) -> T.StructType:
    """The type of :func:`typed` values of a contract; any objects are variants."""

    def one(f: Field) -> T.DataType:
        kind = _SCALARS.get(f.kind) or struct_type(f.kind)
        return T.ArrayType(kind) if f.many else kind

    return T.StructType([T.StructField(name, one(f)) for name, f in CONTRACTS[contract].items()])


def _within(at: str, name: str) -> str:
    return f"{at}.{name}" if at else name


def _is_object(v: Column, at: str = "") -> Column:
    return F.coalesce(F.try_variant_get(v, f"$.{at}" if at else "$", "map<string, binary>").isNotNull(), F.lit(False))


def _scalar(v: Column, at: str, kind: str) -> Column:
    """A scalar of that kind at a path; null for anything that is not one. Numbers may stand as text, truth values as words or 0 and 1."""
    text = V.text_at(v, at)
    if kind == "string":
        return text
    number = V.number_at(v, at)
    if kind == "boolean":
        words = F.when(F.lower(text).isin("true", "yes", "on", "t", "y", "1"), True).when(F.lower(text).isin("false", "no", "off", "f", "n", "0"), False)
        return F.coalesce(F.when(number == 1, True).when(number == 0, False), words)
    number = F.coalesce(number, text.try_cast("double"))
    return number if kind == "double" else F.when(number == F.floor(number), number.try_cast("long"))


def faults(v: Column, contract: str) -> Column:
    """What is wrong with a variant that should be a contract's object: an array of "path: fault" in the order of its fields, empty if nothing is."""
    return F.when(_is_object(v), _object_faults(v, "", contract, F.lit(""))).otherwise(F.array(F.lit("not an object")))


def _object_faults(v: Column, at: str, contract: str, path: Column) -> Column:
    return F.flatten(F.array(*[_faults(v, _within(at, name), f, F.concat(path, F.lit(name))) for name, f in CONTRACTS[contract].items()]))


def _faults(v: Column, at: str, f: Field, path: Column) -> Column:
    """Of what stands at a path of a variant: parts are read from the whole by their paths, as each part taken out would be a copy."""
    none = F.array().cast("array<string>")
    fault = lambda text: F.array(F.concat(path, F.lit(f": {text}")))
    if f.many:
        each = f._replace(many=False, required=True, nullable=False)
        good, word = V.is_array(v, at), "a list"
        inner = F.flatten(F.transform(V.elements(v, at), lambda e, i: _faults(e, "", each, F.concat(path, F.lit("["), i, F.lit("]")))))
    elif f.kind in _NAMES:
        value = _scalar(v, at, f.kind)
        good, word, inner = value.isNotNull(), f"a {_NAMES[f.kind]}", none
        if f.allowed:
            inner = F.when(~value.isin(*f.allowed), fault("not a known value")).otherwise(none)
        if f.low is not None:
            inner = F.when(~value.between(f.low, f.high), fault(f"not within {f.low:g} and {f.high:g}")).otherwise(none)
    else:
        good, word = _is_object(v, at), "an object"
        inner = none if f.kind == "object" else _object_faults(v, at, f.kind, F.concat(path, F.lit(".")))
    there = v if not at else V.at(v, at)
    other = F.when(there.isNull(), fault("missing") if f.required else none).when(F.is_variant_null(there), none if f.nullable else fault("null"))
    return F.when(good, inner).otherwise(other.otherwise(fault(f"not {word}")))


def typed(v: Column, contract: str, at: str = "") -> Column:
    """A contract's object, at a path of a variant, as a struct of :func:`struct_type`; what is missing has its default, what has a wrong type is null."""

    def value(x: Column, place: str, f: Field) -> Column:
        if f.kind in _NAMES:
            return _scalar(x, place, f.kind)
        return F.when(_is_object(x, place), V.at(x, place) if f.kind == "object" and place else x if f.kind == "object" else typed(x, f.kind, place))

    def one(name: str, f: Field) -> Column:
        place = _within(at, name)
        missing = V.at(v, place).isNull()
        if f.many:
            given = F.transform(V.elements(v, place), lambda e: value(e, "", f))
            empty = F.array().cast(struct_type(contract)[name].dataType)
            return (given if f.nullable else F.when(missing, empty).otherwise(given)).alias(name)
        given = value(v, place, f)
        return (given if f.default is None else F.coalesce(given, F.when(missing, F.lit(f.default)))).alias(name)

    return F.struct(*[one(name, f) for name, f in CONTRACTS[contract].items()])

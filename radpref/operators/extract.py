"""Typed columns out of an event's semi-structured payload, by chains of fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radpref.functions import variants as V
from radpref.functions.text import blank, strip


def _truthy_text(v: Column, path: str) -> Column:
    """A path's value as text if it counts as true; what is only blanks does."""
    return F.when(V.truthy(v, path), V.shown(v, path))


def _text(v: Column, path: str) -> Column:
    """A path's string, as it stands, unless it is blank."""
    t = V.text_at(v, path)
    return F.when(~blank(t), t)


def _first_object(v: Column, *paths: str) -> Column:
    return F.coalesce(*[F.when(V.is_object(v, p), V.at(v, p)) for p in paths])


def _first_object_at(path: str, v: Column, *paths: str) -> Column:
    """What stands at a path within :func:`_first_object`, copied alone."""
    out = F.when(V.is_object(v, paths[0]), V.at(v, f"{paths[0]}.{path}"))
    for p in paths[1:]:
        out = out.when(V.is_object(v, p), V.at(v, f"{p}.{path}"))
    return out


def parse_payload(events: DataFrame) -> DataFrame:
    """Adds ``payload`` and ``issues`` (variants, null if bad), ``payload_failed`` and ``is_skipped``.

    An event is skipped unless its reward signal's ``send_to_curator`` counts as true: the text "false" does.
    """
    out = events.withColumns({"payload": V.parse(F.col("input_payload_json")), "issues": V.parse(F.col("issues_json"))})
    return out.withColumns({
        "payload_failed": F.col("payload").isNull() & ~blank(F.col("input_payload_json")),
        "is_skipped": ~V.truthy(F.col("payload"), "reward_signal.send_to_curator"),
    })


def extract(parsed: DataFrame) -> DataFrame:
    """Adds impressions, prompt, exam, findings, reward, versions and timings."""
    p = F.col("payload")
    flat = lambda c: F.when(F.col(c) != "", F.col(c))
    sources = [
        ("generated_impression", flat("generated_impression")),
        ("input_payload_json.generator_response.output.impression_text", _truthy_text(p, "generator_response.output.impression_text")),
        ("input_payload_json.impression_text", _truthy_text(p, "impression_text")),
        ("impression_text", flat("impression_text")),
    ]
    source = F.coalesce(*[F.when(c.isNotNull(), F.lit(n)) for n, c in sources])
    timing = F.coalesce(*[F.when(V.truthy(p, k), V.at(p, k)) for k in ("timing", "latency_breakdown")])
    stamp = lambda *ks: F.coalesce(*[_truthy_text(p, k) for k in ks])
    code = lambda i: _truthy_text(i, "code")
    codes = F.filter(F.transform(V.elements(F.col("issues")), code), lambda c: c.isNotNull())

    def milliseconds(*ks: str) -> Column:
        out = V.number_at(F.col("timing"), ks[-1])
        for k in reversed(ks[:-1]):
            out = F.when(V.truthy(F.col("timing"), k), V.number_at(F.col("timing"), k)).otherwise(out)
        return out

    out = parsed.withColumns({
        "generated": F.coalesce(*[c for _, c in sources]),
        "generator_output_source": source,
        "case": _first_object(p, "case", "generator_request.case"),
        "inputs": _first_object(p, "inputs", "generator_request.inputs"),
        "structured_findings": _first_object_at("observation_payload.structured_findings", p, "inputs", "generator_request.inputs"),
        "timing": timing,
        "reward_score": V.number_at(p, "reward_signal.score"),
        "reward_reason": V.text_at(p, "reward_signal.reason"),
        "send_to_curator": V.at(p, "reward_signal.send_to_curator"),
        "issue_codes": F.coalesce(codes, F.array().cast("array<string>")),
        "prompt_text": F.coalesce(*[_text(p, k) for k in ("prompt_text", "prompt", "generator_request.prompt_text", "generator_request.prompt")]),
        "generator_model_version": strip(F.coalesce(*[_text(p, k) for k in ("generator_response.model_version", "generator_response.model", "generator_request.model", "generator_request.model_version", "model", "model_version")])),
        "reflector_model_version": strip(F.coalesce(*[_text(p, k) for k in ("reflector_response.model_version", "reflector_response.model", "reflector_model", "reflector_model_version")])),
        "reflector_triggered": F.when(F.col("issues").isNotNull() & ~F.is_variant_null("issues"), F.coalesce(V.length(F.col("issues")) > 0, F.lit(False))),
        "submitted_to_queue_at": stamp("submitted_to_queue_at", "queued_at"),
        "human_approved_at": stamp("human_approved_at", "approved_at"),
        "modality": V.text_at(p, "case.exam.modality"),
        "body_part": V.text_at(p, "case.exam.body_part"),
    })
    return out.withColumns({
        "fallback_used": F.coalesce(F.col("generator_output_source") != "generated_impression", F.lit(False)),
        "findings_text": V.text_at(F.col("inputs"), "source_text.findings_text"),
        "projection": V.text_at(F.col("case"), "exam.projection"),
        "agent_latency_ms": milliseconds("agent_latency_ms", "generation_ms"),
        "eval_latency_ms": milliseconds("eval_latency_ms", "evaluation_ms"),
    })


def findings(extracted: DataFrame) -> DataFrame:
    """Adds ``findings``: the valid ones (objects with a label that isn't blank), with their place among all.

    ``presence`` follows the deterministic grader (a JSON null reads "none"), ``judge_presence`` the judge.
    """

    def one(f: Column, i: Column) -> Column:
        # a JSON null is there, but has no text
        said = F.lower(strip(F.coalesce(V.shown(f, "presence"), F.when(V.at(f, "presence").isNotNull(), "none"))))
        return F.struct(
            (i + 1).alias("pos"),
            F.coalesce(_truthy_text(f, "finding_id"), _truthy_text(f, "id"), F.concat(F.lit("finding_"), (i + 1).cast("string"))).alias("finding_id"),
            F.nullif(strip(V.text_at(f, "label")), F.lit("")).alias("label"),
            F.coalesce(said, F.lit("")).alias("presence"),
            F.when(V.truthy(f, "presence"), said).otherwise("unknown").alias("judge_presence"),
            V.text_at(f, "severity").alias("severity"),
            V.text_at(f, "location").alias("location"),
            V.number_at(f, "measurements.size_mm").alias("size_mm"),
            F.coalesce(V.number_at(f, "measurements.tolerance_pct"), F.when(V.at(f, "measurements.tolerance_pct").isNull(), 10.0)).alias("tolerance_pct"),
            V.at(f, "critical_flags").alias("critical_flags"),
            V.at(f, "evidence").alias("evidence"),
        )

    valid = F.filter(F.transform(V.elements(F.col("structured_findings")), one), lambda f: f["label"].isNotNull())
    return extracted.withColumn("findings", valid)

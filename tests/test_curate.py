"""Whole events: golden values worked out by hand, and the odd cases."""

import json

import pytest

from radpref.operators.judge import ask_judge, choose_provider, json_object_in, parse_evaluation, prompts
from radpref.plans.curate import NotFoundError, Settings, curate, curate_one, flatten, latest, prepare
from radpref.plans.rollups import observed
from radpref.schemas import OUTPUT_COLUMNS, REQUEST, request_faults
from radpref.sources.events import fetch, fetch_sql, from_rows, health, read_events, read_json_file
from radpref.sources.output import append_output, export_training, training_records
from radpref.streaming.stream import curate_stream, read_stream
from pyspark.sql import functions as F

HUMAN = "1. Moderate left pneumothorax. 2. Nodule of 12 mm in the right lung on PA view. 3. No effusion."


def event(request="r1", findings=(), human=HUMAN, generated=HUMAN, send=True, prompt="Report this.", payload=None, **more):
    body = {
        "case": {"exam": {"modality": "DX", "body_part": "CHEST", "projection": "PA and lateral"}},
        "inputs": {"observation_payload": {"structured_findings": list(findings)}, "source_text": {"findings_text": "seen"}},
        "prompt_text": prompt,
        "reward_signal": {"score": 0.7, "reason": "fine", "send_to_curator": send},
    }
    return {"request_id": request, "tenant_id": "t", "site_id": "s", "decision": "PASS", "disposition": "edited", "human_impression": human, "generated_impression": generated, "input_payload_json": body if payload is None else payload} | more


FINDINGS = [
    {"label": "Pneumothorax", "presence": "present", "severity": "moderate", "location": "left"},
    {"label": " Nodule ", "presence": "Present", "location": "right lower lobe", "measurements": {"size_mm": 13, "tolerance_pct": 10}},
    {"label": "Rib fracture", "presence": "present", "severity": "mild"},
    {"label": "Effusion", "presence": "absent"},
    {"label": "Nodule", "presence": None},
    {"label": 5},
    "text",
    {"label": "  "},
]


@pytest.fixture(scope="module")
def rows(spark):
    events = [
        event(findings=FINDINGS),
        event("skip", send=False),
        event("text-false", send="false"),
        event("no-findings"),
        event("bad-json", payload="{nope"),
        event("blank", generated="  ", human=None, findings=FINDINGS),
        event("zero", findings=[{"label": "Nodule", "presence": "present", "measurements": {"size_mm": 0}}]),
        event("null-tolerance", findings=[{"label": "Nodule", "presence": "present", "measurements": {"size_mm": 12, "tolerance_pct": None}}]),
        event("rejected", generated=None, disposition=" Rejected "),
        event("pending", disposition=" ", findings=FINDINGS),
        event("other", disposition="deferred"),
        event("missed", generated="Stable.", findings=[FINDINGS[0]], disposition="accepted"),
        event("nested", generated=None, payload={"generator_response": {"output": {"impression_text": "From output."}, "model": " m1 "}, "generator_request": {"prompt": "Q"}, "reward_signal": {"send_to_curator": 1, "score": -1}, "timing": {"agent_latency_ms": 0, "generation_ms": 4}}),
    ]
    curated = curate(from_rows(spark, events)).persist()
    return {r["request_id"]: r.asDict(recursive=True) for r in flatten(curated).join(curated.select("request_id", "error"), "request_id").collect()}


def test_columns(rows):
    assert list(rows["r1"])[: len(OUTPUT_COLUMNS)] == list(OUTPUT_COLUMNS) and len(OUTPUT_COLUMNS) == 66


def test_golden_clinical(rows):
    r = rows["r1"]
    assert r["finding_recall_generated"] == 0.6667 and r["false_negative_rate_generated"] == 0.3333
    assert r["finding_precision_generated"] == 1.0  # of the labels Pneumothorax and Nodule
    assert r["critical_finding_capture_rate_generated"] == 1.0 and r["laterality_accuracy_generated"] == 1.0 and r["severity_accuracy_generated"] == 1.0
    assert json.loads(r["missed_findings_generated"]) == ["Rib fracture"] and json.loads(r["missed_critical_generated"]) == []
    # (.6667 * .3 + .25 + .6667 * .2 + .15 + .1) / 1
    assert abs(r["clinical_accuracy_score"] - 0.8334) < 1e-4
    checks = json.loads(r["finding_checks_json"])
    assert [c["presence"] for c in checks] == ["present", "present", "present", "absent", "none"]
    assert json.loads(r["clinical_accuracy_json"])["absent_finding_accuracy_human"] == 1.0


def test_golden_fields(rows):
    r = rows["r1"]
    # pneumothorax: side and grade right, views missing; nodule: side right, lateral view missing, size within 10 %
    assert (r["laterality_error_rate"], r["severity_error_rate"], r["projection_error_rate"], r["measurement_error_rate"]) == (0.0, 0.0, 1.0, 0.0)
    assert r["overall_field_error_rate"] == round(2 / 6, 4)


def test_feedback(rows):
    r = rows["r1"]
    assert (r["is_human_overridden"], r["is_human_accepted"], r["human_feedback_edit_distance"], r["curator_reward_score"]) == (True, True, 0, 3.0)
    assert rows["rejected"]["human_feedback_normalized_edit_distance"] == 1.0 and rows["rejected"]["curator_reward_score"] == -8.0
    assert rows["pending"]["curator_reward_score"] is None and rows["pending"]["is_human_accepted"] is None
    assert rows["other"]["curator_reward_score"] == 0.0 and rows["other"]["is_dpo_training_ready"]
    assert rows["missed"]["curator_reward_score"] == -5.0  # accepted, but a critical finding is missed


def test_readiness(rows):
    r = rows["r1"]
    assert r["is_dpo_ready"] and r["is_dpo_training_ready"] and json.loads(r["dpo_record"]) == {"prompt": "Report this.", "chosen": HUMAN, "rejected": HUMAN}
    assert rows["blank"]["has_generated_output"] and not rows["blank"]["has_dpo_pair"]
    assert rows["blank"]["clinical_accuracy_score"] is None and rows["no-findings"]["clinical_accuracy_score"] is None
    assert not rows["pending"]["is_dpo_training_ready"]


def test_skipped(rows):
    for k in ("skip", "bad-json"):
        r = rows[k]
        assert json.loads(r["missing_fields"]) == ["send_to_curator=False — row skipped"] and r["preferred_output"] is None and r["total_tokens"] == 0 and r["reward_label"] is None
    assert rows["skip"]["modality"] == "DX"
    assert rows["text-false"]["has_dpo_pair"]  # a text that isn't empty counts as true
    assert rows["bad-json"]["error"] == "payload is not JSON"


def test_errors(rows):
    assert rows["zero"]["error"] and rows["null-tolerance"]["error"] and rows["r1"]["error"] is None


def test_fallbacks(rows):
    r = rows["nested"]
    assert (r["dispreferred_output"], r["prompt_text"], r["generator_model_version"], r["agent_latency_ms"], r["reward_label"]) == ("From output.", "Q", "m1", 4.0, "bad")
    trace = json.loads(r["curator_response"])["trace"]
    assert trace["fallback_used"] and trace["generator_output_source"].endswith("output.impression_text")


def test_strict_mode_fails(spark):
    bad = from_rows(spark, [event(findings=[{"label": "Nodule", "presence": "present", "measurements": {"size_mm": 0}}])])
    with pytest.raises(Exception, match="size of 0"):
        curate(bad, Settings(strict=True)).collect()


def side(status, lat=None, sev=None, critical=False):
    return {"mention_status": status, "laterality_applicable": lat is not None, "laterality_correct": lat, "severity_applicable": sev is not None, "severity_correct": sev, "critical_captured": critical, "evidence": None}


def test_judge(spark):
    findings = [{"label": "Mass", "presence": "present"}, {"label": "Edema", "presence": "present", "id": "E 2"}, {"label": "Cyst", "presence": "absent"}]
    answer = {
        "finding_judgments": [
            {"finding_id": "finding_1", "label": "Mass", "presence": "present", "is_critical": True, "generated": side("mentioned", True, True, True), "human": side("mentioned", True, False)},
            {"finding_id": "e-2", "label": "?", "presence": "present", "is_critical": False, "generated": side("uncertain", False), "human": side("Mentioned ")},
            {"finding_id": "x", "label": "cyst", "presence": "absent", "is_critical": False, "generated": side("negated"), "human": side("mentioned")},
        ],
        "hallucinated_findings_generated": [{"label": "Nodule", "severity": ""}],
    }
    events = from_rows(spark, [event("a", findings), event("b", [*findings, {"label": "Other", "presence": "present"}]), event("c", findings)])
    asked = prompts(prepare(events))
    calls = asked.collect()
    assert len(calls) == 3 and '\\"finding_id\\":\\"finding_1\\"' in calls[0]["judge_prompt"]

    def client():
        seen = []

        def call(prompt):
            seen.append(prompt)
            if "Other" not in prompt and len(seen) % 2:
                raise OSError("busy")
            return {"answer": f"```json\n{json.dumps(answer)}\n```", "prompt_tokens": 1000, "completion_tokens": 1000, "total_tokens": 2000}

        return call

    answers = ask_judge(asked.coalesce(1), client).where("request_id <> 'c'")
    out = {r["request_id"]: r for r in curate(events, Settings(mode="llm"), answers).collect()}
    ca = out["a"]["response"]["analytics"]["clinical_accuracy"]
    assert (ca["finding_recall_generated"], ca["finding_precision_generated"], ca["finding_recall_human"]) == (0.5, 0.5, 1.0)
    assert (ca["laterality_accuracy_generated"], ca["severity_accuracy_human"], ca["absent_finding_accuracy_human"]) == (0.5, 0.0, 0.0)
    assert (ca["critical_finding_capture_rate_generated"], ca["critical_finding_capture_rate_human"], ca["impression_agreement_score"]) == (1.0, 0.0, 0.5)
    assert ca["hallucinated_findings_generated"] == [{"label": "Nodule"}] and out["a"]["response"]["analytics"]["estimated_cost_usd"] == 0.0005
    assert out["b"]["error"] == "no judgment of a finding" and out["c"]["error"] == "no judgment of this event"
    bad = spark.createDataFrame([("{}x",), ('{"finding_judgments": [{"finding_id": "a"}]}',), (None,)], "a string").select(parse_evaluation(F.col("a")))
    assert [r[0] for r in bad.collect()][1:] == [None, None]


def test_sources_and_sinks(spark, tmp_path):
    rows = [event("a", timestamp=1), event("b", findings=FINDINGS)]
    events = from_rows(spark, rows)
    assert fetch(events, "b").count() == 1 and fetch(events, "none").count() == 0
    events.createOrReplaceTempView("review_events")
    assert fetch_sql(spark, "review_events", "a").first()["request_id"] == "a"
    events.write.parquet(str(tmp_path / "p"))
    plan = fetch(spark.read.parquet(str(tmp_path / "p")), "a")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(request_id,a)" in plan
    (tmp_path / "one.json").write_text(json.dumps([rows[1] | {"input_payload_json": json.dumps(rows[1]["input_payload_json"]), "has_embedding": "true", "vector_doc_json": "x"}]))
    single = read_json_file(spark, str(tmp_path / "one.json")).first()
    assert single["request_id"] == "b" and single["has_embedding"] is True
    out = flatten(curate(events), F.lit("2026-01-02 03:04:05").cast("timestamp"))
    append_output(out, str(tmp_path / "t"))
    append_output(out, str(tmp_path / "t"), files_per_day=1)
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.count() == 4 and stored.where("created_date = '2026-01-02'").count() == 4
    assert latest(stored.drop("created_date")).count() == 2
    export_training(out, str(tmp_path / "x"))
    assert spark.read.json(str(tmp_path / "x")).count() == training_records(out).count() == 2


def test_repeated_answers_count_once(spark):
    """Of several stored answers the last; an event stays one row."""
    findings = [{"label": "Mass", "presence": "present"}]
    said = lambda status: json.dumps({"finding_judgments": [{"finding_id": "finding_1", "label": "Mass", "presence": "present", "is_critical": False, "generated": side(status), "human": side(status)}]})
    answers = spark.createDataFrame(
        [("a", said("mentioned"), 5, "2026-01-02 00:00:00"), ("a", said("negated"), 7, "2026-01-03 00:00:00"), ("a", said("negated"), 7, "2026-01-03 00:00:00"), ("b", None, 1, "2026-01-04 00:00:00"), ("b", said("mentioned"), 2, "2026-01-01 00:00:00")],
        "request_id string, answer string, prompt_tokens long, answered_at string",
    )
    out = {r["request_id"]: r for r in curate(from_rows(spark, [event("a", findings), event("b", findings)]), Settings(mode="llm"), answers).collect()}
    assert len(out) == 2 and out["a"]["response"]["analytics"]["prompt_tokens"] == 7
    recall = {k: r["response"]["analytics"]["clinical_accuracy"]["finding_recall_generated"] for k, r in out.items()}
    assert recall == {"a": 0.0, "b": 1.0}  # an answer that failed doesn't hide one that didn't


def test_prompt_states_the_rules(spark):
    text = prompts(prepare(from_rows(spark, [event(findings=FINDINGS)]))).first()["judge_prompt"]
    for rule in ("Cannot exclude", "rule it out", "sentence", "is_critical", "critical_captured", "no percentages", "hallucinated_findings_human", "agreement_common_finding_ids", "INPUT:"):
        assert rule in text, rule


def test_provider():
    assert [choose_provider(*x) for x in (("vertexai", True, True), ("genai", True, True), (" GenAI ", False, True), ("other", True, False), (None, False, True))] == ["vertexai", "genai", "genai", "vertexai", "genai"]
    with pytest.raises(RuntimeError):
        choose_provider("vertexai", False, False)


@pytest.mark.parametrize(("answer", "found"), [('```json\n{"a": 1}\n```', '{"a": 1}'), ('Here: {"a": {"b": 2}} as asked', '{"a": {"b": 2}}'), ("none", "none"), ("```\n{}\n```", "{}")])
def test_json_of_an_answer(spark, answer, found):
    assert spark.createDataFrame([(answer,)], "a string").select(json_object_in(F.col("a"))).first()[0] == found


def test_curate_one(spark):
    events = from_rows(spark, [event("a", findings=FINDINGS), event("zero", findings=[{"label": "Nodule", "presence": "present", "measurements": {"size_mm": 0}}])])
    assert curate_one(events, "a").first()["response"]["readiness"]["is_dpo_ready"]
    assert curate_one(events, "zero").first()["error"]
    with pytest.raises(NotFoundError):
        curate_one(events, "b")
    with pytest.raises(ValueError, match="size of 0"):
        curate_one(events, "zero", Settings(strict=True))


def test_health(spark, tmp_path):
    spark.range(1).createOrReplaceTempView("some_events")
    assert health(spark, "some_events", str(tmp_path)) == {"source_available": True, "sink_available": True}
    assert health(spark, None, f"{tmp_path}/none") == {"source_available": False, "sink_available": False}


def test_settings_of_the_environment(monkeypatch):
    monkeypatch.setenv("CLINICAL_ACCURACY_MODE", " LLM ")
    monkeypatch.setenv("LLM_MODEL_NAME", "m")
    monkeypatch.setenv("GOOGLE_API_KEY", "k")
    got = Settings.from_env()
    assert (got.mode, got.model, got.api_key) == ("llm", "m", "k") and "'k'" not in repr(got)


def test_request_faults(spark):
    good = {"request_id": "r", "case": {"accession_number": "1", "exam": {"modality": "DX"}}, "inputs": {"observation_payload": {"structured_findings": [{"label": "a", "presence": "present", "confidence": 1.0}]}}}
    bad = {"case": {"exam": {"modality": "ZZ", "laterality": "X"}}, "inputs": {"observation_payload": {"structured_findings": [{"presence": "maybe", "confidence": 1.5}]}}}
    rows = spark.createDataFrame([(json.dumps(good),), (json.dumps(bad),), ("{}",)], "t string").select(request_faults(F.from_json("t", REQUEST)))
    got = [r[0] for r in rows.collect()]
    assert got[0] == [] and len(got[1]) == 7 and got[2] == ["no request_id"]


def test_filters_reach_the_scan(spark, tmp_path):
    """A key or tenant is pushed down to the files; columns that nothing asks for are not read; filters on metrics copy no formulas."""
    from_rows(spark, [event("a", findings=FINDINGS), event("b")]).write.parquet(str(tmp_path / "e"))
    out = flatten(curate(read_events(spark, str(tmp_path / "e"))))
    plan = out.where("tenant_id = 't' AND request_id = 'a'").select("request_id", "reward_score")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(tenant_id,t)" in plan and "EqualTo(request_id,a)" in plan and "has_embedding" not in plan
    filtered = out.where("clinical_accuracy_score > 0.5 AND curator_reward_score > 0")
    assert len(filtered._jdf.queryExecution().optimizedPlan().toString()) < 3 * len(out._jdf.queryExecution().optimizedPlan().toString())
    assert [r["request_id"] for r in filtered.collect()] == ["a"]


def test_stream(spark, tmp_path):
    events = from_rows(spark, [event("a", findings=FINDINGS), event("b", send=False)])
    events.write.parquet(str(tmp_path / "in"))
    counts = {}
    curate_stream(read_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "c"), counts=counts.__setitem__).awaitTermination()
    assert (counts[0]["rows"], counts[0]["skipped"]) == (2, 1)
    got = spark.read.parquet(str(tmp_path / "out"))
    drop = ["created_at", "created_date"]
    assert sorted(map(str, got.drop(*drop).select(*[c for c in OUTPUT_COLUMNS if c not in drop]).collect())) == sorted(map(str, flatten(curate(events)).drop(*drop).collect()))


def test_counts_in_passing(spark):
    out, seen = observed(curate(from_rows(spark, [event("a"), event("b", send=False), event("c", prompt=None)])))
    out.write.format("noop").mode("overwrite").save()
    assert (seen.get["rows"], seen.get["skipped"], seen.get["dpo_ready"], seen.get["missing_prompt_text"]) == (3, 1, 1, 1)


def test_plan_is_map_only(spark):
    plan = flatten(curate(from_rows(spark, [event()])))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan

"""What a query doesn't return isn't worked out for it: words of the plan that only other metrics' formulas have."""

import pytest

from radpref.operators.judge import prompts
from radpref.plans.curate import curate, flatten, prepare
from radpref.queries import QUERIES
from radpref.sources.events import from_rows

DATA = "/root/testdata/sf0.001"
GRADES, SIZES, DISTANCE = "angulation|tension", "centimeters", "levenshtein"


@pytest.fixture(scope="module", autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    yield
    spark.conf.unset("spark.sql.debug.maxToStringFields")


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(
    ("name", "has", "lacks"),
    [
        ("payload_extraction", (), (GRADES, SIZES, DISTANCE)),
        ("readiness_scores", (), (GRADES, SIZES, DISTANCE)),
        ("training_export", (), (GRADES, SIZES, DISTANCE)),
        ("finding_checks", (GRADES,), (SIZES, DISTANCE)),
        ("label_rollup", (GRADES,), (SIZES, DISTANCE)),
        ("clinical_accuracy", (GRADES,), (SIZES, DISTANCE)),
        ("field_performance", (GRADES, SIZES), (DISTANCE,)),
        ("feedback_rewards", (GRADES, DISTANCE), (SIZES,)),
        ("judge_accuracy", (GRADES, SIZES), (DISTANCE,)),
    ],
)
def test_plan(spark, name, has, lacks):
    plan = plan_of(QUERIES[name](spark, DATA))
    assert [w for w in has if w not in plan] == [] and [w for w in lacks if w in plan] == []


def test_types_are_not_asked_for_as_text(spark):
    """Values of a payload are told apart by what they can be read as, not by the text of their type, once for each fallback."""
    assert plan_of(flatten(curate(from_rows(spark, [{"request_id": "a"}])))).count("SchemaOfVariant") < 5


def test_prompts_need_no_sentences(spark):
    events = from_rows(spark, [{"request_id": "a"}])
    assert GRADES in plan_of(prepare(events))
    assert GRADES not in plan_of(prompts(prepare(events, "is_skipped", "can_grade", "findings", "case", "generated")))


def test_contracts_read_by_whole_paths(spark):
    """No copy of a part is made to look into it, and no type is asked for as text."""
    plan = plan_of(QUERIES["request_contracts"](spark, DATA))
    assert "SchemaOfVariant" not in plan and "$.case.exam.modality" in plan

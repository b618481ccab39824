"""Text rules, quirks included."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from radpref.functions import text as T
from radpref.functions import variants as V
from radpref.operators.feedback import bounded_first, edit_distance


def one(spark, *columns, **values):
    frame = spark.createDataFrame([tuple(values.values()) or (1,)], ", ".join(f"{k} {'string' if isinstance(v, (str, type(None))) else 'double' if isinstance(v, float) else 'int'}" for k, v in values.items()) or "x int")
    return frame.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("1. Large mass. 2. No edema.", ["large mass.", "no edema."]),
        ("Mass of 1.5 cm. Stable!", ["mass of 1.5 cm.", "stable!"]),
        ("1.5 cm nodule.", ["5 cm nodule."]),  # what looks like a list number goes
        ("- mass\n- no edema", ["- mass - no edema"]),  # without full stops all is one sentence
        ("a. b.", ["a.", "b."]),
        ("  ", []),
        (None, []),
    ],
)
def test_sentences(spark, text, expected):
    assert one(spark, T.sentences(T.normalize(F.col("t"))), t=text)[0] == expected


@pytest.mark.parametrize(
    ("label", "text", "sentence"),
    [
        ("fracture", "no fracture. fracture of rib.", "fracture of rib."),
        ("fracture", "no mass or fracture.", None),
        ("fracture", "fx of rib.", "fx of rib."),
        ("pe", "pulmonary embolism seen.", "pulmonary embolism seen."),
        ("rib fracture", "rib fx.", None),  # only a whole label has another form
        ("mass", "massive edema.", None),
        ("c++ \\E(sign)", "c++ \\e(sign)x", None),
        ("fracture", "fx of hand. fracture of rib.", "fracture of rib."),  # the label itself first
    ],
)
def test_assertion(spark, label, text, sentence):
    assert one(spark, T.assertion(F.col("l"), T.affirmed(T.sentences(F.col("t")))), l=label, t=text)[0] == sentence


def test_denied_and_mentioned_both(spark):
    s = T.sentences(F.col("t"))
    row = one(spark, T.is_denied(F.lit("mass"), s), T.assertion(F.lit("mass"), T.affirmed(s)).isNotNull(), t="no mass on left. mass on right.")
    assert tuple(row) == (True, True)


@pytest.mark.parametrize(
    ("location", "text", "expected"),
    [("left upper lobe", "mass on left", True), ("Cleft", "mass on left", True), ("left and right", "on right", False), ("bilateral", "in both lungs", True), ("midline", "central mass", None), (" ", "left", None), ("left", None, None)],
)
def test_side(spark, location, text, expected):
    assert one(spark, T.side_matches(F.col("l"), F.col("t")), l=location, t=text)[0] is expected


@pytest.mark.parametrize(
    ("severity", "text", "expected"),
    [("Severe", "large mass", True), ("mod", "moderate mass", True), ("mild", "severe mass", False), ("large", "large mass", None), ("tension", "tension", None), (None, "mild", None)],
)
def test_grade(spark, severity, text, expected):
    assert one(spark, T.grade_matches(F.col("s"), F.col("t")), s=severity, t=text)[0] is expected


def test_critical_grades_are_substrings(spark):
    assert tuple(one(spark, T.is_critical_grade(F.lit("very LARGE")), T.is_critical_grade(F.lit("nondisplaced")), T.is_critical_grade(F.lit("mild")), T.is_critical_grade(F.col("n")), n=None)) == (True, True, False, False)


@pytest.mark.parametrize(("projection", "text", "expected"), [("PA and lateral", "pa and lateral views", True), ("PA and lateral", "pa view", False), ("portable", "upright film", True), ("frontal", "ap film", True), ("other", "ap", None), (None, "ap", None)])
def test_views(spark, projection, text, expected):
    assert one(spark, T.views_match(F.col("p"), F.col("t")), p=projection, t=text)[0] is expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [("12 x 15 mm", [12.0, 15.0]), ("3.0 by 2.5 cm", [30.0, 25.0]), ("12 x 15 x 20 mm", [15.0, 20.0]), ("120 mmHg", [120.0]), ("grade 2 15 mm", [2.0, 15.0]), ("1.5 Centimeters", [15.0]), ("none", [])],
)
def test_sizes(spark, text, expected):
    assert one(spark, T.sizes_mm(F.col("t")), t=text)[0] == expected


def test_distance_form_breaks_decimals(spark):
    assert one(spark, T.normalize_for_distance(F.col("t")), t="  A ,b ;C 1.5\n x ")[0] == "a, b; c 1. 5 x"


def test_variants(spark):
    v = V.parse(F.col("j"))
    kinds = {
        '{"a": 5}': (None, 5.0, True, True),
        '{"a": "5"}': ("5", None, True, True),
        '{"a": ""}': ("", None, False, True),
        '{"a": true}': (None, 1.0, True, True),
        '{"a": null}': (None, None, False, True),
        '{"a": []}': (None, None, False, True),
        '{"a": {}}': (None, None, False, True),
        '{"a": [0]}': (None, None, True, True),
        "[]": (None, None, False, False),
        '"{\\"a\\": \\"x\\"}"': ("x", None, True, True),
        "nonsense": (None, None, False, False),
        " ": (None, None, False, False),
    }
    frame = spark.createDataFrame([(k,) for k in kinds], "j string").select("j", V.text_at(v, "a"), V.number_at(v, "a"), V.truthy(V.at(v, "a")), V.is_object(v))
    assert {r[0]: tuple(r)[1:] for r in frame.collect()} == kinds


def levenshtein(a, b):
    """By whole rows of the table at once, with numpy."""
    x, y = (np.array([ord(c) for c in t], np.int64) for t in (a, b))
    each = np.arange(len(y) + 1)
    row = each.copy()
    for i, c in enumerate(x, 1):
        step = np.empty_like(row)
        step[0] = i
        step[1:] = np.minimum(row[1:] + 1, row[:-1] + (y != c))
        row = np.minimum.accumulate(step - each) + each
    return int(row[-1])


def test_edit_distance_is_exact_and_quick_on_long_texts(spark):
    r = random.Random(4)
    letters = "abcde é漢😀ß,."
    text = lambda n: "".join(r.choice(letters) for _ in range(n))

    def changed(t, n):
        out = list(t)
        for _ in range(n):
            k = r.randrange(len(out))
            how = r.random()
            if how < 0.4:
                out[k] = r.choice(letters)
            elif how < 0.7:
                out.insert(k, r.choice(letters))
            elif len(out) > 1:
                del out[k]
        return "".join(out)

    pairs = [(t := text(n), changed(t, k)) for n in (1, 2, 9, 70, 600) for k in (0, 1, 5, 8, 9, 60, 70, 400)] + [("", ""), ("", "ab"), ("ab", ""), ("kitten", "sitting"), ("ab", "ba"), (text(700), text(20)), (text(900), text(950))]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = {x["i"]: (x["d"], x["e"]) for x in rows.select("i", bounded_first(F.col("a"), F.col("b")).alias("d"), edit_distance(F.col("a"), F.col("b"))[0].alias("e")).collect()}
    for i, (a, b) in enumerate(pairs):
        want = levenshtein(a, b)
        assert got[i] == (want, want if a and b else None), (a, b)
    long = text(20_000)
    near = [changed(long, k) for k in (3, 40, 300)]
    rows = spark.createDataFrame([(long, b) for b in near], "a string, b string").coalesce(1)
    query = rows.select(bounded_first(F.col("a"), F.col("b")).alias("d"))
    assert [x["d"] for x in query.collect()] == [levenshtein(long, b) for b in near]

    def took(distance):
        near = rows.where(F.length("b") > 0).limit(1).select(distance(F.col("a"), F.col("b")))
        near.collect()
        began = time.perf_counter()
        near.collect()
        return time.perf_counter() - began

    assert took(bounded_first) < took(F.levenshtein) / 2  # three edits in 20,000 characters

"""Clinical accuracy of both impressions against structured findings, by rules over sentences.

Everything is computed inside one event's arrays, so it needs no shuffle and runs as well in a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from radpref.functions import variants as V
from radpref.functions.text import affirmed, assertion, blank, grade_of, grade_said, is_critical_grade, let, normalize, safe_rate, sentences, side_of, side_said

#: Weights of the composite score: recall, critical capture, 1 - false negatives, side, grade. Fixed values.
WEIGHTS = {"finding_recall": 0.30, "critical_finding_capture_rate": 0.25, "found": 0.20, "laterality_accuracy": 0.15, "severity_accuracy": 0.10}


def with_sentences(events: DataFrame) -> DataFrame:
    """Adds both texts normalised (``gen_normal``, ``hum_normal``), ``placed``, and whether metrics can be had: findings, and a text that isn't blank.

    ``placed``: each finding ``f`` with its side, its grade, whether that is critical, and the sentences that
    assert it (``g``, ``h``); null where nothing can be graded.
    """
    able = (F.size("findings") >= 0) & (V.length(F.col("structured_findings")) > 0) & ~(blank(F.col("generated")) & blank(F.col("human_impression")))
    out = events.withColumns({"gen_normal": normalize(F.col("generated")), "hum_normal": normalize(F.col("human_impression")), "can_grade": F.coalesce(able, F.lit(False))})
    out = out.withColumns({"gen_affirmed": affirmed(sentences(F.col("gen_normal"))), "hum_affirmed": affirmed(sentences(F.col("hum_normal")))})

    def place(f: Column) -> Column:
        found = lambda label: F.struct(
            f.alias("f"), side_of(f["location"]).alias("side"), grade_of(f["severity"]).alias("grade"), is_critical_grade(f["severity"]).alias("critical"),
            assertion(label, F.col("gen_affirmed")).alias("g"), assertion(label, F.col("hum_affirmed")).alias("h"),
        )
        return let(F.lower(f["label"]), found)

    return out.withColumn("placed", F.when(F.col("can_grade"), F.transform("findings", place)))


def finding_checks(placed: Column) -> Column:
    """One struct for each valid finding: mentioned, right side and right grade in either text, critical."""

    def check(x: Column) -> Column:
        f = x["f"]
        urgent = (f["presence"] == "present") & x["critical"]
        none = F.lit(None).cast("string")
        return F.struct(
            none.alias("finding_id"),
            f["label"].alias("label"),
            f["presence"].alias("presence"),
            f["severity"].alias("severity"),
            f["location"].alias("location"),
            none.alias("normalized_finding_type"),
            x["g"].isNotNull().alias("mentioned_in_generated"),
            x["h"].isNotNull().alias("mentioned_in_human"),
            side_said(x["side"], x["g"]).alias("laterality_match_generated"),
            side_said(x["side"], x["h"]).alias("laterality_match_human"),
            grade_said(x["grade"], x["g"]).alias("severity_match_generated"),
            grade_said(x["grade"], x["h"]).alias("severity_match_human"),
            x["critical"].alias("is_critical"),
            (urgent & x["g"].isNotNull()).alias("critical_captured_generated"),
            (urgent & x["h"].isNotNull()).alias("critical_captured_human"),
            none.alias("generated_evidence"),
            none.alias("human_evidence"),
            none.alias("reasoning"),
        )

    return F.transform(placed, check)


def composite(rates: dict[str, Column]) -> Column:
    """Weighted mean of the rates that are there."""
    parts = [(rates[k], w) for k, w in WEIGHTS.items()]
    total = sum((F.coalesce(r * w, F.lit(0.0)) for r, w in parts), F.lit(0.0))
    weight = sum((F.when(r.isNotNull(), w).otherwise(0.0) for r, w in parts), F.lit(0.0))
    return F.when(weight > 0, F.bround(total / weight, 4))


def metrics_struct(rates: dict[str, Column] | Column, counts: dict[str, Column], lists: dict[str, Column], checks: Column) -> Column:
    """The accuracy struct in the order it is stored; counts that a mode doesn't have are 0, lists empty. ``rates``: formulas, or a struct of values."""
    zero, empty = F.lit(0).cast("long"), F.array().cast("array<string>")
    no_finds = F.array().cast("array<map<string, string>>")
    kinds = ("finding_recall", "finding_precision", "false_negative_rate", "critical_finding_capture_rate", "laterality_accuracy", "severity_accuracy")
    order = [
        *[f"{k}_generated" for k in kinds], "impression_agreement_score", *[f"{k}_human" for k in kinds],
        "absent_finding_accuracy_generated", "absent_finding_accuracy_human",
    ]
    numbers = [
        "total_findings_checked", "present_findings_count", "critical_findings_count", "findings_with_laterality", "findings_with_severity", "absent_findings_count",
        *[f"findings_with_{k}_{t}" for k in ("laterality", "severity") for t in ("generated", "human")],
        *[f"{t}_{k}_mentions_count" for t in ("generated", "human") for k in ("supported", "unsupported")],
    ]
    names = [f"missed_{k}_{t}" for k in ("findings", "critical") for t in ("generated", "human")]

    def whole(r: Column) -> Column:
        return F.struct(
            *[r[k].alias(k) for k in order],
            *[counts.get(k, zero).cast("long").alias(k) for k in numbers],
            *[F.coalesce(lists.get(k, empty), empty).alias(k) for k in names],
            *[F.coalesce(lists.get(k, no_finds), no_finds).alias(k) for k in ("hallucinated_findings_generated", "hallucinated_findings_human")],
            checks.alias("finding_checks"),
            composite({k: r[f"{k}_generated"] for k in WEIGHTS if k != "found"} | {"found": 1.0 - r["false_negative_rate_generated"]}).alias("clinical_accuracy_score"),
        )

    if isinstance(rates, Column):
        return whole(rates)
    # rates are worked out once; and readers of single fields find a value here, not a formula to copy
    return let(F.struct(*[rates[k].alias(k) for k in order]), whole)


#: What is counted of a check, as bits of one number: a count is then a comparison of numbers, not a walk through structs.
_MARKS = ("present", "absent", "generated", "human", "critical", "side_known", "side_generated", "side_human", "grade_known", "grade_generated", "grade_human", "captured_generated", "captured_human")
_BIT = {k: 1 << i for i, k in enumerate(_MARKS)}


def _marks(c: Column) -> Column:
    tests = {
        "present": c["presence"] == "present",
        "absent": c["presence"] == "absent",
        "generated": c["mentioned_in_generated"],
        "human": c["mentioned_in_human"],
        "critical": c["is_critical"],
        "side_known": c["laterality_match_generated"].isNotNull(),
        "side_generated": c["laterality_match_generated"],
        "side_human": c["laterality_match_human"],
        "grade_known": c["severity_match_generated"].isNotNull(),
        "grade_generated": c["severity_match_generated"],
        "grade_human": c["severity_match_human"],
        "captured_generated": c["critical_captured_generated"],
        "captured_human": c["critical_captured_human"],
    }
    bits = [F.when(t, _BIT[k]).otherwise(0) for k, t in tests.items()]
    return sum(bits[1:], bits[0])


def _counted(out: DataFrame) -> DataFrame:
    """Adds ``n_...`` for all that rates are made of, from ``marks``, and the distinct labels ``said_generated``, ``said_human`` and ``true_labels``."""

    def n(*have: str, lack: str | None = None) -> Column:
        want = sum(_BIT[k] for k in have)
        mask = want | (_BIT[lack] if lack else 0)
        return F.size(F.filter("marks", lambda m: m.bitwiseAND(F.lit(mask)) == want))

    counts = {"all": F.size("checks"), "present": n("present"), "absent": n("absent"), "critical": n("present", "critical"), "sided": n("side_known"), "scaled": n("grade_known")}
    for t in ("generated", "human"):
        counts |= {
            f"hits_{t}": n("present", t),
            f"captured_{t}": n(f"captured_{t}"),
            f"side_{t}": n("side_known", f"side_{t}"),
            f"grade_{t}": n("grade_known", f"grade_{t}"),
            f"left_out_{t}": n("absent", lack=t),
        }
    labels = lambda keep: F.array_distinct(F.transform(F.filter("checks", keep), lambda c: c["label"]))
    named = {"said_generated": labels(lambda c: c["mentioned_in_generated"]), "said_human": labels(lambda c: c["mentioned_in_human"]), "true_labels": labels(lambda c: c["presence"] == "present")}
    return out.withColumns({f"n_{k}": c for k, c in counts.items()} | named)


def _rates(has_generated: Column, has_human: Column) -> Column:
    n = lambda k: F.col(f"n_{k}")
    rates = {}
    for t, has in (("generated", has_generated), ("human", has_human)):
        said = F.col(f"said_{t}")
        # the other text's sides and grades count only where the generated one's do
        rates |= {
            f"finding_recall_{t}": safe_rate(n(f"hits_{t}"), n("present")),
            f"finding_precision_{t}": safe_rate(F.size(F.array_intersect(said, F.col("true_labels"))), F.size(said)),
            f"false_negative_rate_{t}": safe_rate(n("present") - n(f"hits_{t}"), n("present")),
            f"critical_finding_capture_rate_{t}": safe_rate(n(f"captured_{t}"), n("critical")),
            f"laterality_accuracy_{t}": safe_rate(n(f"side_{t}"), n("sided")),
            f"severity_accuracy_{t}": safe_rate(n(f"grade_{t}"), n("scaled")),
            f"absent_finding_accuracy_{t}": safe_rate(F.when(has, n(f"left_out_{t}")).otherwise(0), n("absent")),
        }
    shared, every = F.array_intersect("said_generated", "said_human"), F.array_union("said_generated", "said_human")
    rates["impression_agreement_score"] = safe_rate(F.size(shared), F.size(every))
    return F.struct(*[c.alias(k) for k, c in rates.items()])


def _field(name: str):
    return lambda c: F.coalesce(c[name], F.lit(False))


def _known(name: str):
    return lambda c: c[name].isNotNull()


def _not(keep):
    return lambda c: ~keep(c)


def _and(*keeps):
    def both(c: Column) -> Column:
        out = keeps[0](c)
        for k in keeps[1:]:
            out = out & k(c)
        return out

    return both


def clinical_accuracy(graded: DataFrame) -> DataFrame:
    """Adds ``clinical_accuracy``; null where nothing can be graded."""
    out = graded.withColumn("checks", finding_checks(F.col("placed")))
    out = _counted(out.withColumn("marks", F.transform("checks", _marks)))
    out = out.withColumn("rates", _rates(~blank(F.col("generated")), ~blank(F.col("human_impression"))))
    labels = lambda *keeps: F.transform(F.filter("checks", _and(*keeps)), lambda c: c["label"])
    present, lists = (lambda c: c["presence"] == "present"), {}
    for t in ("generated", "human"):
        unsaid = _not(lambda c, t=t: c[f"mentioned_in_{t}"])
        lists |= {f"missed_findings_{t}": labels(present, unsaid), f"missed_critical_{t}": labels(present, _field("is_critical"), unsaid)}
    counts = {"total_findings_checked": "all", "present_findings_count": "present", "critical_findings_count": "critical", "findings_with_laterality": "sided", "findings_with_severity": "scaled", "absent_findings_count": "absent"}
    result = metrics_struct(F.col("rates"), {k: F.col(f"n_{n}") for k, n in counts.items()}, lists, F.col("checks"))
    own = ["marks", "rates", "said_generated", "said_human", "true_labels", *[c for c in out.columns if c.startswith("n_")]]
    return out.withColumn("clinical_accuracy", F.when(F.col("checks").isNotNull(), result)).drop(*own)

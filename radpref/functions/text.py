r"""Text rules of impressions as column functions: sentences, negation, terms, sides, grades, sizes, views.

Regular expressions carry ``(?U)`` so that ``\s``, ``\d`` and ``\b`` follow Unicode. All functions map null
to null or to an empty result and stay inside the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---
ABBREVIATIONS = {
    "ptx": "pneumothorax",
    "fx": "fracture",
    "pe": "pulmonary embolism",
    "ett": "endotracheal tube",
    "sbo": "small bowel obstruction",
    "ich": "intracranial hemorrhage",
    "sdh": "subdural hematoma",
    "edh": "epidural hematoma",
    "sah": "subarachnoid hemorrhage",
    "tb": "tuberculosis",
    "oa": "osteoarthritis",
    "druj": "distal radioulnar joint",
}
#: In this order; the first that fits a grade, either way round, decides.
SEVERITY_TERMS = {
    "mild": ("mild", "small", "minimal", "trace"),
    "moderate": ("moderate",),
    "severe": ("severe", "large", "extensive", "massive"),
    "displaced": ("displaced", "displacement", "angulation", "angulated"),
}
SIDE_TERMS = {"left": ("left",), "right": ("right",), "bilateral": ("bilateral", "bilaterally", "both")}
#: In this order; the first that a location holds decides its side.
LOCATION_SIDES = (
    ("left upper lobe", "left"),
    ("left lower lobe", "left"),
    ("right upper lobe", "right"),
    ("right lower lobe", "right"),
    ("left", "left"),
    ("right", "right"),
    ("bilateral", "bilateral"),
)
#: Phrases that begin with "no" ("no evidence of") need no entry: the word alone negates.
NEGATIONS = ("no", "not", "none", "negative", "clear of", "without", "free of", "absent", "denies", "ruled out", "excluded")
CRITICAL_GRADES = ("severe", "moderate", "large", "displaced", "displacement", "angulated", "angulation", "tension")
VIEW_TERMS = {
    "pa": ("pa", "posteroanterior", "posterior-anterior"),
    "ap": ("ap", "anteroposterior", "anterior-posterior"),
    "lateral": ("lateral",),
    "oblique": ("oblique",),
    "frontal": ("frontal", "pa", "ap", "posteroanterior", "anteroposterior"),
    "portable": ("portable", "upright"),
    "upright": ("upright", "erect", "standing"),
    "supine": ("supine", "recumbent"),
}
SIZE_PATTERN = r"(?iU)(\d+\.?\d*)\s*(?:x|by)?\s*(\d+\.?\d*)?\s*(cm|mm|centimeters?|millimeters?)"
#: What ``(?U)\s`` matches.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# --- end of fixed values ---


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is worked out once, however often a nested lambda refers to it."""
    return F.transform(F.array(value), body)[0]


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE))


def blank(c: Column) -> Column:
    """Null, or nothing but white space."""
    return F.coalesce(strip(c) == "", F.lit(True))


def normalize(c: Column) -> Column:
    """Stripped, lower-cased, white space collapsed; null becomes empty."""
    return F.coalesce(F.regexp_replace(F.lower(strip(c)), r"(?U)\s+", " "), F.lit(""))


def spaced(normal: Column) -> Column:
    """A normalised text with its punctuation followed by one blank and preceded by none."""
    return F.btrim(F.regexp_replace(normal, r" *([,.;:]) *", "$1 "))


def normalize_for_distance(c: Column) -> Column:
    """As :func:`normalize`, and :func:`spaced`."""
    return spaced(normalize(c))


def has_any(text: Column, terms: tuple[str, ...]) -> Column:
    """Whether one of some fixed terms stands in the text as a whole word: one compiled pattern."""
    return F.rlike(text, F.lit(rf"(?U)\b(?:{'|'.join(terms)})\b"))


def has_term(text: Column, term: Column) -> Column:
    """Whether a term that is itself a column stands in the text as a whole word."""
    quoted = F.replace(term, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    whole = F.rlike(text, F.concat(F.lit(r"(?U)\b\Q"), quoted, F.lit(r"\E\b")))
    # patterns of columns are compiled a row; most texts don't hold the term at all
    return F.when(F.contains(text, term), whole).when(text.isNotNull() & term.isNotNull(), F.lit(False))


def sentences(text: Column) -> Column:
    """Sentences of a normalised text, without list numbers and empty pieces."""
    pieces = F.split(strip(text), r"(?U)(?<=[.!?])\s+")
    bare = F.transform(pieces, lambda s: strip(F.regexp_replace(strip(s), r"(?U)^\d+\.\s*", "")))
    return F.coalesce(F.filter(bare, lambda s: s != ""), F.array().cast("array<string>"))


def is_negated(sentence: Column) -> Column:
    return has_any(sentence, NEGATIONS)


def affirmed(sentence_array: Column) -> Column:
    return F.filter(sentence_array, lambda s: ~is_negated(s))


def other_form(label: Column) -> Column:
    """The abbreviation of a label that is a full term, or the full term of one that is an abbreviation."""
    pairs = [*ABBREVIATIONS.items(), *((v, k) for k, v in ABBREVIATIONS.items())]
    return F.element_at(F.create_map(*[F.lit(x) for p in pairs for x in p]), label)


def assertion(label: Column, affirmed_sentences: Column) -> Column:
    """The first affirmed sentence with the label, else the first with its other form, else null.

    A label is mentioned exactly if this is not null.
    """
    first = lambda term: F.get(F.filter(affirmed_sentences, lambda s: has_term(s, term)), F.lit(0))
    return F.coalesce(first(label), let(other_form(label), lambda o: F.when(o.isNotNull(), first(o))))


def is_denied(label: Column, sentence_array: Column) -> Column:
    """Whether the label, in either form, stands in a negated sentence."""
    either = lambda s: has_term(s, label) | F.coalesce(has_term(s, other_form(label)), F.lit(False))
    return F.exists(sentence_array, lambda s: is_negated(s) & either(s))


def _first_case(pairs: list[tuple[Column, Column]]) -> Column:
    out = F.when(*pairs[0])
    for condition, value in pairs[1:]:
        out = out.when(condition, value)
    return out


def side_of(location: Column) -> Column:
    return let(F.lower(strip(location)), lambda low: _first_case([(F.contains(low, F.lit(term)), F.lit(side)) for term, side in LOCATION_SIDES]))


def grade_of(severity: Column) -> Column:
    fits = lambda low, key: (low != "") & (F.contains(low, F.lit(key)) | F.contains(F.lit(key), low))
    return let(F.lower(strip(severity)), lambda low: _first_case([(fits(low, key), F.lit(key)) for key in SEVERITY_TERMS]))


def _by_key(key: Column, sentence: Column, table: dict[str, tuple[str, ...]]) -> Column:
    return _first_case([(key == k, has_any(sentence, terms)) for k, terms in table.items()])


def side_matches(location: Column, sentence: Column) -> Column:
    """Null without a side or a sentence."""
    return let(side_of(location), lambda side: side_said(side, sentence))


def grade_matches(severity: Column, sentence: Column) -> Column:
    """Null without a known grade or a sentence."""
    return let(grade_of(severity), lambda grade: grade_said(grade, sentence))


def side_said(side: Column, sentence: Column) -> Column:
    """Whether a sentence has a term of a side as :func:`side_of` gives it."""
    return F.when(sentence.isNotNull() & side.isNotNull(), _by_key(side, sentence, SIDE_TERMS))


def grade_said(grade: Column, sentence: Column) -> Column:
    """Whether a sentence has a term of a grade as :func:`grade_of` gives it."""
    return F.when(sentence.isNotNull() & grade.isNotNull(), _by_key(grade, sentence, SEVERITY_TERMS))


def is_critical_grade(severity: Column) -> Column:
    return F.coalesce(F.rlike(F.lower(strip(severity)), F.lit("|".join(CRITICAL_GRADES))), F.lit(False))


def required_views(projection: Column) -> Column:
    low = F.lower(strip(projection))
    return F.filter(F.array(*[F.when(has_any(low, (v,)), F.lit(v)) for v in VIEW_TERMS]), lambda v: v.isNotNull())


def views_match(projection: Column, sentence: Column) -> Column:
    """Null without a known view or a sentence; else whether all required views are there."""
    return views_said(required_views(projection), sentence)


def views_said(views: Column, sentence: Column) -> Column:
    """The same of views as :func:`required_views` gives them."""
    there = lambda v: F.coalesce(_by_key(v, sentence, VIEW_TERMS), F.lit(False))
    return F.when(sentence.isNotNull() & (F.size(views) > 0), F.forall(views, there))


def sizes_mm(sentence: Column) -> Column:
    """All sizes of a sentence in mm, in order; both of a pair."""
    # one walk through the sentence; parts are looked for in what it finds
    found = F.regexp_extract_all(sentence, F.lit(SIZE_PATTERN), F.lit(0))

    def values(size: Column) -> Column:
        part = lambda k: F.regexp_extract(size, SIZE_PATTERN, k)
        factor = F.when(F.lower(part(3)).startswith("c"), 10.0).otherwise(1.0)
        pair = F.array(part(1).try_cast("double") * factor, F.nullif(part(2), F.lit("")).try_cast("double") * factor)
        return F.filter(pair, lambda v: v.isNotNull())

    return F.coalesce(F.flatten(F.transform(found, values)), F.array().cast("array<double>"))


def safe_rate(n: Column, d: Column) -> Column:
    """n / d to four places (ties to even); null where d is 0."""
    return F.when(d != 0, F.bround(n.cast("double") / d.cast("double"), 4))

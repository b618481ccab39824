"""Secret scanning: candidate strings, and a random forest that removes false findings.

Candidates are cut out of whole texts by regular expressions; the forest sees a candidate's length, how its
characters follow one another, how much of it common words cover, its path and its neighbouring words. It
is trained from labelled findings: the caller's, or a small table written by hand. Built-in functions and
JVM learners only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from radpref.llm.common import SPACES, cut, thinned
from radpref.llm.labelled import secret_examples
from radpref.llm.quality_rules import let

_CHARS = "[A-Za-z0-9+/_=-]"
_NAME = r"(?:token|secret|passw|passphrase|key|auth(?!ors?\b)|credential)[a-z0-9_-]{0,20}[\"']?\s{0,3}[=:]\s{0,3}[\"']?"
#: What stands before the value of a named secret.
NAMED = rf"(?i){_NAME}$"
_VALUE = r"[^\s\"'`]"
_AFTER_NAME = rf"(?<=[=:]\s{{0,3}}[\"']?)(?<=(?i:{_NAME}))(?![=:])"
#: Heads of private keys; named values with a mark after or within a run; runs of 16 characters or more with a digit
#: among them, without a name before the value; other named values of six characters or more, up to a blank or quote.
CANDIDATE = (
    rf"-----BEGIN [A-Z ]{{0,30}}PRIVATE KEY-----|{_AFTER_NAME}(?={_VALUE}{{6}}){_CHARS}*+[!@#$%^*~]{_VALUE}*+"
    rf"|(?:(?<!{_CHARS})|{_AFTER_NAME})(?!(?i:[a-z0-9_-]{{0,40}}?{_NAME}){_VALUE}{{6}})(?=[A-Za-z+/_=-]*[0-9]){_CHARS}{{16,}}+"
    rf"|{_AFTER_NAME}{_VALUE}{{6,}}(?<![,;.)\]}}>])"
)
PREFIXES = {"private key": r"^-----BEGIN", "cloud key": r"^(AKIA|ASIA)[A-Z0-9]{16}$", "repository token": r"^gh[pousr]_[A-Za-z0-9]{30,}$", "signed token": r"^eyJ[A-Za-z0-9_-]{10,}"}
_PASSWORD = r"(?i)(passw|passphrase|secret|credential)[a-z0-9_-]{0,20}[\"']?\s{0,3}[=:]\s{0,3}[\"']?$"
_PLACEHOLDER = r"(?i)(example|placeholder|xxxx|0000000|1234567|your[_-])"


@dataclass(frozen=True)
class SecretParams:
    """At most ``max_labels`` findings of each label are learnt from; the ``dictionary`` commonest words cover candidates."""

    max_labels: int = 2000
    dictionary: int = 200
    neighbours: int = 128
    trees: int = 20
    depth: int = 6
    around: int = 48
    seed: int = 5


def findings(docs: DataFrame, p: SecretParams = SecretParams(), path: str = "source") -> DataFrame:
    """``doc_id, path, start, end, value, before, after``: all candidates, with the text around them.

    Offsets are in code points, end exclusive. A null text has none.
    """
    text = F.col("text")
    some = docs.where(text.rlike("[0-9=:]|PRIVATE KEY"))
    found = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    row = F.monotonically_increasing_id().alias("row")
    some = some.select(row, F.col("doc_id").cast("long").alias("doc_id"), F.col(path).cast("string").alias("path"), found.alias("found"), text.alias("text")).where(F.size("found") > 0)
    gaps = F.split("text", CANDIDATE, -1)
    pieces = let(gaps, lambda gs: F.zip_with(F.col("found"), F.slice(gs, 1, F.size("found")), lambda v, g: F.struct(v.alias("value"), F.char_length(g).alias("gap"), F.right(g, F.lit(p.around)).alias("before"))))
    after = let(gaps, lambda gs: F.transform(F.slice(gs, 2, F.size("found")), lambda g: F.left(g, F.lit(p.around))))
    each = some.select("row", "doc_id", "path", F.posexplode(F.arrays_zip(pieces.alias("f"), after.alias("after"))).alias("at", "x"))
    each = each.select("row", "doc_id", "path", "at", "x.f.value", "x.f.gap", "x.f.before", "x.after")
    upto = Window.partitionBy("row").orderBy("at")
    end = F.sum(F.col("gap") + F.char_length("value")).over(upto)
    return each.withColumn("end", end.cast("int")).select("doc_id", "path", (F.col("end") - F.char_length("value")).alias("start"), "end", "value", "before", "after")


def kind() -> Column:
    out = F.when(F.col("before").rlike(NAMED), "named")
    for name, pattern in PREFIXES.items():
        out = out.when(F.col("value").rlike(pattern), name)
    return out.when(F.col("value").rlike("^[0-9]+$"), "digits").when(F.col("value").rlike("^[0-9a-fA-F]+$"), "hex").otherwise("other")


def rule_labels(found: DataFrame) -> DataFrame:
    """Findings labelled by rule, for those who would rather learn from their own documents: 1 where a named value or a known form stands, 0 elsewhere and for placeholders.

    A named value of letters alone, as prose has them after a colon, is 1 only with capitals within or the name of a password.
    """
    plain = F.col("value").rlike(r"^[\p{L}'’-][\p{Ll}'’-]*$") & ~F.col("before").rlike(_PASSWORD)
    real = (F.col("kind").isin(*PREFIXES) | ((F.col("kind") == "named") & ~plain)) & ~F.col("value").rlike(_PLACEHOLDER)
    return found.withColumn("label", real.cast("double"))


def examples(docs: DataFrame) -> DataFrame:
    """The findings labelled by hand, as rows of :func:`findings` with ``kind`` and ``label``; they have no path."""
    rows = docs.sparkSession.createDataFrame(secret_examples(), "before string, value string, after string, label double")
    return rows.withColumn("path", F.lit(None).cast("string")).withColumn("kind", kind())


def dictionary(docs: DataFrame, p: SecretParams) -> list[str]:
    """The commonest words of three to eight ASCII letters in all texts."""
    words = docs.select(F.explode(F.split(F.lower("text"), SPACES)).alias("w")).where(F.col("w").rlike("^[a-z]{3,8}$"))
    return [r["w"] for r in words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(p.dictionary).collect()]


def features(found: DataFrame, words: list[str], p: SecretParams) -> DataFrame:
    v, n = F.col("value"), F.greatest(F.char_length("value"), F.lit(1)).cast("double")
    share = lambda pattern: F.regexp_count(v, F.lit(pattern)) / n
    covered = (n - F.char_length(F.regexp_replace(F.lower(v), "|".join(sorted(words, key=lambda w: (-len(w), w))) or "(?!)", ""))) / n
    entropy = let(F.split(v, ""), lambda cs: F.aggregate(F.array_distinct(cs), F.lit(0.0), lambda a, c: a - let(F.size(F.filter(cs, lambda x: x == c)) / n, lambda q: q * F.log2(q))))
    numbers = {
        "f_length": n,
        "f_upper": share("[A-Z]"),
        "f_digit": share("[0-9]"),
        "f_mark": share("[^A-Za-z0-9]"),
        "f_class_changes": share("(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]"),
        "f_vowel_turns": share("(?i)(?<=[bcdfghjklmnpqrstvwxz])[aeiouy]"),
        "f_repeats": share(r"(.)(?=\1)"),
        "f_hex": v.rlike("^[0-9a-fA-F]+$").cast("double"),
        "f_entropy": entropy,
        "f_covered": covered,
        "f_named": F.col("before").rlike(NAMED).cast("double"),
    }
    tokens = lambda c, tag: F.transform(F.regexp_extract_all(F.lower(c), F.lit(r"[^\s\w]|\w+"), F.lit(0)), lambda w: F.concat(F.lit(tag), w))
    near = F.concat(F.slice(F.reverse(tokens(F.col("before"), "<")), 1, 3), F.slice(tokens(F.col("after"), ">"), 1, 2), F.array(F.concat(F.lit("path:"), F.coalesce("path", F.lit("")))))
    return found.withColumns(numbers).withColumn("near", near)


def stages(p: SecretParams) -> tuple[HashingTF, VectorAssembler]:
    names = ["f_length", "f_upper", "f_digit", "f_mark", "f_class_changes", "f_vowel_turns", "f_repeats", "f_hex", "f_entropy", "f_covered", "f_named"]
    return HashingTF(numFeatures=p.neighbours, binary=True, inputCol="near", outputCol="near_hash"), VectorAssembler(inputCols=[*names, "near_hash"], outputCol="features")


def distinct_findings(labelled: DataFrame) -> DataFrame:
    """One row for each label and (value, before, after): copies under other ids or paths count once."""
    key = ["label", "value", "before", "after"]
    rest = F.struct(*[c for c in labelled.columns if c not in key])
    return labelled.groupBy(*key).agg(F.min_by(rest, F.coalesce("path", F.lit(""))).alias("rest")).select(*key, "rest.*")


def train(labelled: DataFrame, p: SecretParams = SecretParams()) -> PipelineModel | float:
    """A forest from rows of :func:`features` with ``label``; of one label only, that label's number."""
    labelled = cut(distinct_findings(labelled), "distinct-findings")
    order = F.xxhash64("value", "before", F.lit(p.seed))
    sides = [thinned(labelled.where(F.col("label") == y), p.max_labels, p.seed, "value", "before", "after").orderBy(order, "value", "before", "after").limit(p.max_labels) for y in (0.0, 1.0)]
    sample = cut(sides[0].unionByName(sides[1]), "labelled-findings")
    labels = {r["label"] for r in sample.select("label").distinct().collect()}
    if len(labels) < 2:
        return labels.pop() if labels else 0.0
    hashing, assembler = stages(p)
    forest = RandomForestClassifier(numTrees=p.trees, maxDepth=p.depth, seed=p.seed, featureSubsetStrategy="onethird")
    return PipelineModel([hashing, assembler, forest.fit(assembler.transform(hashing.transform(sample)))])


def secret_scan(docs: DataFrame, labelled: DataFrame | None = None, p: SecretParams = SecretParams(), path: str = "source") -> DataFrame:
    """All candidates with the forest's verdict.

    ``labelled``: findings (columns of :func:`findings`) with ``label`` 0 or 1; left out, the forest learns
    from the examples by hand. Returns ``doc_id, start, end, kind, value_sha256, score, is_secret``.
    Repeated rows are scanned one by one; no candidates give an empty result.
    """
    found = findings(docs, p, path)
    words = dictionary(docs, p)
    described = cut(features(found.withColumn("kind", kind()), words, p), "findings")
    known = features(examples(docs) if labelled is None else labelled, words, p)
    model = train(known, p)
    if isinstance(model, float):
        scored = described.withColumn("score", F.lit(model))
    else:
        scored = model.transform(described).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    return scored.select("doc_id", "start", "end", "kind", F.sha2("value", 256).alias("value_sha256"), "score", (F.col("score") >= 0.5).alias("is_secret"))

"""From raw documents to token files: each stage takes what its predecessor kept.

``STAGES`` holds (name, function) pairs; a function takes ``(spark, docs, sf_dir)`` and returns a frame,
which is written as Parquet and read again as the next one's ``docs``. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from radpref.llm.common import cut, table
from radpref.llm.decontamination import decontaminate
from radpref.llm.mixing import mixed_documents
from radpref.llm.near_dedup import near_duplicates
from radpref.llm.token_output import token_output
from radpref.llm.toxicity import fit, score_documents


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return score_documents(docs, fit(docs, table(spark, sf_dir, "labels"))).where("toxic_score < 0.5").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (shingles of five words, similarity 0.8) one document stays.

    Rows that share an id are one document and stay or go together. Rows of no id all stay.
    """
    copies = near_duplicates(docs).where("not kept").select("doc_id")
    return docs.join(copies, "doc_id", "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).where(F.size("hit_spans") == 0).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of each source, whole, as often as its target asks for."""
    return mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: token files, and what they hold of each document."""
    return token_output(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("token-id output", write_tokens),
]

#: Toxicity is a trained model and token ids come from a tokenizer: neither can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""A training-corpus pipeline: five stages, each over all that its predecessor kept.

Documents that language ID rejects go; of each group of near-duplicates (word
shingles of five, similarity 0.8) one stays; documents with a passage of the
benchmark go; secrets are cut out of the texts; what is left is mixed to the
sources' target weights. All stages but the last return the columns of
``documents``; the last adds how much of each document the mix takes.

Edge cases are those of the operators; an empty table passes through as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pixelframe.llm.common import discard, load, stored_alone
from pixelframe.llm.decontamination import drop_contaminated
from pixelframe.llm.jaccard import keep_one
from pixelframe.llm.language import keep_recognised
from pixelframe.llm.mixing import mixed_documents
from pixelframe.llm.registry import query
from pixelframe.llm.secrets import redact


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that have no language the model knows."""
    return keep_recognised(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, that of the smallest id."""
    return keep_one(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold ten words in a row of a benchmark item."""
    return drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with the words it takes of each."""
    return mixed_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mixing", mixing),
]
#: Language ID has no SQL twin; the tests hold ``run`` against the operators' brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; of the tables they store only the last one stays."""
    docs, own = load(spark, sf_dir, "documents"), False
    for name, stage in STAGES:
        kept = stored_alone(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"pipeline-{name}")
        if own:
            discard(docs)
        docs, own = kept, True
    return docs


@query("pipeline", ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)

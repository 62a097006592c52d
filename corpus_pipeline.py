"""From raw documents to token ids: five stages, each written as Parquet and read by the next.

Quality rules, near duplicates, personal data, mixing to target weights, SentencePiece encoding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import budget, fertility, jaccard, nbest, pii
from feedloom.llm.common import kept_table
from feedloom.llm.queries import WEIGHTS, levels
from feedloom.session import prepare

#: Share of the tokens that the mix keeps, each document at most once.
MIX_PERCENT = 95


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the fertility bands reject go."""
    found, name = fertility.fertility_rules(docs)
    return found.where(F.col(f"{name}.kept")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return jaccard.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kinds; n_chars follows the text."""
    found = pii.redacted(docs)
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken to the target weights of domain, language and source."""
    return budget.mixed(docs, levels(), WEIGHTS, MIX_PERCENT, max_epochs=1).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text with its alternatives, beside all columns but the text."""
    keep = tuple(c for c in docs.columns if c != "text")
    return nbest.encode(docs, keep)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix", mix),
    ("encode", encode),
]

#: No SQL can say what the vocabularies, the field or the search find: tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept_table(stage(spark, docs, sf_dir), f"stage-{name}")
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)

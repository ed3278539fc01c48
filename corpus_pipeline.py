"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tidewell.llm import decontaminate, language, neardup, packing, pii
from tidewell.llm.common import materialize, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Below this mean probability of its best language, a text is in none.
LEAST_SCORE = 0.4


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; texts without letters and null texts go."""
    found = language.predict(docs.select(*COLUMNS), language.train(docs))
    return found.where(F.col("lang_pred") != "und").where(F.col("score") >= LEAST_SCORE).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return neardup.without_copies(docs.select(*COLUMNS))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the windows they share with benchmark items; mostly shared texts go."""
    clean = decontaminate.decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    # texts are written with their candidates, so they are searched once
    found = materialize(pii.candidates(docs.select(*COLUMNS)), "pipeline-candidates")
    clean = pii.replace_spans(found, pii.fit(found.select("candidates")))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 4096 tokens, a row per piece of a document."""
    return packing.pack(docs, packing.vocabulary())


STAGES = [
    ("language_id", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", uncontaminated),
    ("pii", without_personal_data),
    ("packing", packed),
]

#: Trained models and sketches decide the stages, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

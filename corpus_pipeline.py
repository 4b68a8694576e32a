"""The documents table through five operators, from quality rules to packed sequences.

Null and empty texts fail the quality rules, so no later stage of ``run`` meets them; a stage
that is called by itself takes them as its operator says. Repeated rows are rows of their own
but for the third stage, which keeps one row of each key and text. Rows with a null doc_id
stay. An empty table goes through all stages and gives an empty result. Other columns come
along up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changetables.llm import jaccard_join, packing, pseudonyms, quality_classifier, quality_rules
from changetables.llm.queries import END_ID, PSEUDONYM_KEY, SEQUENCE, table, vocabulary
from changetables.session import materialise


#: Rows of a batch on its way to Python. Spark's default suits short rows; whole texts in such
#: numbers would fill both sides' buffers.
BATCH_ROWS = 500


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines that their host repeats."""
    return quality_rules.keep_good(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely good than bad, by their text and their site."""
    _small_batches(spark)
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    _small_batches(spark)
    return jaccard_join.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their personal data replaced; n_chars follows the text."""
    return pseudonyms.rewrite(docs, PSEUDONYM_KEY)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    _small_batches(spark)
    return packing.pack(packing.tokenised_pieces(docs, vocabulary(), SEQUENCE, END_ID), SEQUENCE)


STAGES = [
    ("quality_rules", rules),
    ("quality_classifier", classifier),
    ("ngram_jaccard_join", near_duplicates),
    ("pii", personal_data),
    ("best_fit_packing", sequences),
]

#: Models, keyed permutations and a search have no SQL form; tests/llm compares each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each reads what its predecessor wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs

"""A training corpus from documents: known language, good quality, no near-duplicates, mixed sources, sampled pieces.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents. run() writes each stage's result as a table in the shared folder, so that a later failure
repeats one stage at most. An empty table passes every stage as an empty one, and further columns pass the first
four as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import curriculum, language_gru, piece_sampling, quality_ftrl, simhash_dedup
from quire.llm._shared import table, write_table

QUALITY_AT_LEAST = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents without letters and those that are likelier in none of the known languages than in all together.

    Null, empty and letterless texts go. Repeated rows stay or go together. Null ids and languages are not learned from.
    """
    return language_gru.keep_known(docs, language_gru.train(docs.select("doc_id", "text", "lang")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents that the classifier, fitted on labels of documents still here, scores under QUALITY_AT_LEAST.

    Null and empty texts score by the bias alone. Repeated rows stay or go together; a score right at the limit stays.
    """
    weights = quality_ftrl.train(docs, table(spark, sf_dir, "labels"))
    return quality_ftrl.keep_quality(docs, weights, QUALITY_AT_LEAST)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest id of each group of linked fingerprints.

    Null and empty texts are one group. Of repeated rows one stays; rows with a null id stay only where a group has no id.
    """
    return simhash_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and leave out documents so that sources meet their targets, in training order.

    Null and empty texts have no words and go; a null source is a source; repeated rows are documents of their own.
    """
    return curriculum.mix(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every row, as piece ids; an empty text has one, without ids. Repeated rows get the same samples."""
    return piece_sampling.sample_pieces(docs)


STAGES = [
    ("language_id", language_id),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("sentencepiece", sentencepiece),
]
#: No SQL can express a trained network or sampled segmentations; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""From raw documents to a training mix: five stages, each on all that the one before kept.

``STAGES`` has (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tourledger.llm.common import ensure_checkpoint_dir, table
from tourledger.llm.decontamination import clean_documents
from tourledger.llm.language_id import known_language
from tourledger.llm.mixing import mixed_documents
from tourledger.llm.near_dedup import one_of_each
from tourledger.llm.substring_dedup import without_repeats

#: SQL cannot express hyperdimensional profiles, sketches or suffix sorting.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters go, and all where no language was learned."""
    return known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays."""
    return one_of_each(docs)


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes in strings of 50 that a document of smaller id has too are cut out of the texts."""
    return without_repeats(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth of their words in benchmark windows go."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes words from, with how many: size, source_size, target, taken."""
    return mixed_documents(docs)


STAGES = [
    ("language ID", language),
    ("near duplicates", near_duplicates),
    ("repeated substrings", repeated_substrings),
    ("decontamination", decontaminated),
    ("mixing", mixed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written to ``spark.checkpoint.dir``
    as Parquet and read again as the next one's documents."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

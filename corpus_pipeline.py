"""A corpus from raw documents to packed sequences. Each stage takes (spark, docs, sf_dir) and returns a DataFrame
that is written and read again as the next one's documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from touchline.llm.common import table
from touchline.llm.decontaminate import clean_documents
from touchline.llm.exact_dedup import exact_dedup
from touchline.llm.jaccard import one_of_each
from touchline.llm.packing import pack
from touchline.llm.quality import good_documents
from touchline.session import durable_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of similar shingle sets make (five words, 0.8)."""
    return one_of_each(docs, shingle=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in a sequence."""
    return pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", packed),
]

#: The classifier, alignment and tokeniser are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = f"{durable_dir(spark)}/pipeline/{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

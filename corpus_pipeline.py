"""From raw documents to a token file: stages over the documents table, each written as Parquet.

A stage takes the session, the documents that the stage before it kept, and the folder of the
tables, and works on all of them. All but the last return the columns of documents.
"""

from __future__ import annotations

from contextlib import ExitStack

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tonnage.llm.decontaminate import drop_leaks
from tonnage.llm.minhash import drop_near_duplicates
from tonnage.llm.mixing import mix
from tonnage.llm.quality import keep_good, train
from tonnage.llm.queries import END_OF_TEXT, TOKENIZER, table
from tonnage.llm.ship import workers_find_library
from tonnage.llm.tokens import read_documents, write_tokens
from tonnage.sources.staging import staged


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the base rules or the trained classifier reject."""
    workers_find_library(spark)
    return keep_good(docs, train(docs, table(spark, sf_dir, "labels")))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    workers_find_library(spark)
    return drop_near_duplicates(docs)


def unseen_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold passages of the benchmark."""
    workers_find_library(spark)
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each source to its target weight; a document may come twice."""
    workers_find_library(spark)
    return mix(docs)


def token_file(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the documents' token ids, and return what the file holds for each of them."""
    workers_find_library(spark)
    return read_documents(spark, write_tokens(docs, public_tokenizers.path(TOKENIZER), END_OF_TEXT))


STAGES = [
    ("quality rules", good_documents),
    ("near duplicates", distinct_documents),
    ("benchmark decontamination", unseen_documents),
    ("mixing", mixed_documents),
    ("token output", token_file),
]

#: A trained classifier and a tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents table; each works on what the one before it wrote.

    What a stage wrote is deleted once the next one has written, so no more than two are kept.
    """
    docs, kept = table(spark, sf_dir, "documents"), ExitStack()
    for _, work in STAGES[:-1]:
        written = ExitStack()
        docs = written.enter_context(staged(work(spark, docs, sf_dir)))
        kept.close()
        kept = written
    # The last stage has written its shards when it returns.
    with kept:
        return STAGES[-1][1](spark, docs, sf_dir)

"""From raw documents to packed token sequences, in five stages.

Each stage takes the documents that its predecessor kept, read from Parquet, and returns a
DataFrame; all but the last return the columns of the table they got. Extra columns pass through
under their names. An empty table gives empty results; rows are never identified by doc_id alone,
so repeated rows and null ids are treated row by row, except that near duplicates keep one row.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from textpulse.llm import chunks, langid, mixing, packing, simhash
from textpulse.llm.common import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model does not reject.

    Out go null texts, texts without a letter, and texts farther from every language than training
    texts of their length. The lang column stays as it was.
    """
    return langid.keep_identified(docs, langid.trained(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: a row with the group's smallest id.

    Three-word shingles, links at two or fewer differing bits. Of rows that share that id the
    first stays; in a group without ids, the first row.
    """
    return simhash.first_of_groups(docs, shingle=3, distance=2)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 50 words or more that an earlier one holds; n_chars follows."""
    return chunks.cut_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens have tempered shares of source, language and topic."""
    return mixing.sample(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens, with a checksum of their ids."""
    return packing.digests(packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("mixture", mix_sources),
    ("packing", pack_sequences),
]

#: Classifier, components and raking are not expressible in SQL; the tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each from the table that the former has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs)
    return docs

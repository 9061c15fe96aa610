"""A training corpus from raw documents: good texts, once each, without repeats, packed into sequences."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from merchmill.llm import exact_dedup, minhash_dedup, packing, quality_classifier, suffix_dedup
from merchmill.llm.common import free_stored, stored_alone, table

#: A classifier, sets and suffixes have no SQL; the tests compare each stage with a brute-force version.
ORACLE_SQL = None


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels, doesn't reject."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each different text."""
    return exact_dedup.keep_first_copies(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shared shingles of five words, at a similarity of 0.8 or more."""
    return minhash_dedup.keep_one_of_each_group(docs, words=5, percent=80)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 100-byte strings that start earlier in the corpus too."""
    return suffix_dedup.without_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", good_texts),
    ("exact dedup", first_copies),
    ("MinHash near-dedup", one_of_near_copies),
    ("suffix-array dedup", without_repeats),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; between stages the documents are a table in the shared folder.

    A stage's own tables, and the documents it read, are deleted when its result is written.
    """
    docs, last = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs, path = stored_alone(spark, partial(stage, spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
        free_stored(spark, last)
        last = [path]
    return STAGES[-1][1](spark, docs, sf_dir)

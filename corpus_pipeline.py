"""A corpus pipeline of four operators: each stage works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheetgraph.llm import mil_quality, near_copies, nnls_packing, toxic_grammar
from sheetgraph.llm.common import drop_stash, fold, stash, table
from sheetgraph.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. Labels are learned from the rows its query may learn from."""
    model = mil_quality.train(docs, table(spark, sf_dir, "labels"), fold("_id", 4, 2))
    return mil_quality.keep_good(docs, model, threshold=0.7)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar does not reject."""
    model = toxic_grammar.train(docs, table(spark, sf_dir, "labels"), fold("_id", 5, 0))
    return toxic_grammar.keep_clean(docs, model, threshold=0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least doc_id of each class of texts linked by a five-word Jaccard similarity of 0.8 or more."""
    return near_copies.keep_one(docs, words=5, similarity=0.8)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, in sequences of at most 2048 ids."""
    return nnls_packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("quality", quality), ("toxicity", toxicity), ("simhash", near_duplicates), ("packing", packing)]

#: The classifiers, components and the packing can't be expressed in SQL; tests/llm compares with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written to the shared folder and read again by the next."""
    docs, held = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        docs = stash(out, name)
        drop_stash(held)
        held = docs
    return docs

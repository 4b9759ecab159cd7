"""The training corpus from raw documents, stage by stage.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns what it keeps
of ``docs``. Every result is written and read again before the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dqloom.llm import decontaminate, langid, near_dup, packing, suffix_dedup
from dqloom.llm.common import cut, in_rows
from dqloom.llm.registered import BYTE_BPE, table


#: Documents whose windows are identified with less certainty than this on average are rejected.
LEAST_CERTAINTY = 0.4


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents written in languages the network has learnt; texts without letters go.

    What counts is how surely each window is identified, so a document in several languages stays. Null and empty texts
    go; rows are judged one by one, whatever their ids. An empty table stays empty; without any labelled text all rows go.
    """
    model = langid.train(docs, langid.learnable())
    found = langid.with_language(in_rows(docs), model, ["row"])
    sure = (found["lang_pred"] != langid.UNKNOWN) & (found["certainty"] >= LEAST_CERTAINTY)
    return found.where(sure).select("row.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Rows without id or without words are kept. Rows that repeat an id are judged by their texts; of equal ones the first stays.
    """
    return near_dup.keep_first(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the 50-byte strings that a document with a smaller id has.

    ``n_chars`` stays what it was. Null texts stay null or become empty; rows with equal ids take nothing from each other.
    """
    return suffix_dedup.without_repeats(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark; null and empty texts hold none."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of 2048 ids: each document's pieces and their places.

    A null or empty text is its end id. Rows that repeat an id are packed each for itself.
    """
    return packing.pack_documents(docs, BYTE_BPE, 2048, 1, remember=False)


STAGES = [
    ("language id", in_a_language),
    ("near-duplicates", one_of_each_group),
    ("suffix-array dedup", without_repeats),
    ("decontamination", decontaminated),
    ("packing", packed),
]
#: Training of a network, signatures and tokenizers are beyond SQL; tests hold stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

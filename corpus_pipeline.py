"""The training-data pipeline: STAGES over `documents`, each written as Parquet before the next reads it.

Bad and toxic documents go, one document of each near-duplicate group stays, passages of 50 words
that still repeat anywhere are cut out, and what is left is packed into training sequences. A
document whose whole text is cut out stays with an empty text. Every stage takes an empty table, very long
texts, and extra columns of any name; all but the last return the columns they get.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandflow.llm import minhash, packing, quality, suffix, toxicity
from strandflow.llm.common import cut
from strandflow.llm.queries import table, vocabulary

#: Bytes of a repeated string that is cut out: 50 words of four letters with their blanks. Longer strings
#: would let passages of 50 common words pass (of 51-word windows of ordinary text, 1 in 1,000 is below 256 bytes).
PASSAGE_BYTES = 250


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rules and the classifier. Null and empty texts go; repeated rows share a fate."""
    return quality.keep(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not toxic; a null or empty text is not. Repeated rows share a fate.

    Learned on all labelled documents: the stage before has dropped some of the toxic ones.
    """
    return toxicity.keep(docs, toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: the smallest doc_id. Rows without a doc_id stay, and so do rows that repeat the one that stays."""
    gone = minhash.near_duplicates(docs).filter("not kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(["`{}`".format(c.replace("`", "``")) for c in docs.columns])


def suffix_array(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, its text without repeated passages. Null and empty texts stay as they are; repeated rows empty each other."""
    return suffix.cut_texts(docs, PASSAGE_BYTES)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document. A null or empty text is the end id alone; repeated rows are packed each."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("suffix_array", suffix_array),
    ("packing", pack),
]
#: Classifiers, tokens and suffix arrays are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of `sf_dir`; every stage but the last is written in the shared folder and read again."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = before = cut(stage(spark, docs, sf_dir), name, before)
    return STAGES[-1][1](spark, docs, sf_dir)

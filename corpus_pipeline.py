"""The corpus pipeline: documents through the stages, each a table the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cairnlake.llm.common import table, written
from cairnlake.llm.decontamination import without_items
from cairnlake.llm.minhash import one_of_each_group
from cairnlake.llm.packing import pack
from cairnlake.llm.pseudonyms import pseudonymise_column
from cairnlake.llm.toxicity import fit_on_tables, without_toxic
from cairnlake.llm.vocabulary import tokenizer_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the network does not reject; it learns from ``labels`` of the documents given."""
    return without_toxic(docs, "text", fit_on_tables(spark, docs, sf_dir))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id."""
    return one_of_each_group(docs, "doc_id", "text")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, also not with other numbers, names or units."""
    return without_items(docs, "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text")


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal values in ``text`` replaced by pseudonyms of their format.

    Lengths of values do not change, and so ``n_chars`` stays right.
    """
    return pseudonymise_column(docs, "text")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document in windows of 2048 ids."""
    return pack(docs, "doc_id", "text", tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: Trained networks and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

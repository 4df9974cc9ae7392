"""The corpus pipeline: documents to packed training sequences.

Each stage takes the documents that its predecessor kept and returns documents
with the same columns; the last one returns the pieces of packed sequences.
Every stage's result is written and read again as the input of the next one.

Defined cases: a NULL text counts as empty and an empty table gives no rows in
every stage; extra columns of any name are carried along up to the last stage.
What NULL ids, ties and repeated rows do is said at the operator a stage calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbwright.llm import exact_dedup, mixing, packing, quality_model, similar
from plumbwright.sources.scratch import write_table
from plumbwright.sources.tables import read_table

# A trained model, components of links and tokenizers are beyond SQL.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model expects to be good; it learns from the ratings in ``labels``."""
    return quality_model.select(docs, quality_model.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal without white space."""
    return exact_dedup.unique_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts with a five-word Jaccard similarity of 0.8 or more."""
    return similar.one_of_similar(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length."""
    return packing.pack(docs, with_ids=False)


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

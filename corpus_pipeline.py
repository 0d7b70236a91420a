"""The corpus pipeline: documents in, packed token sequences out.

Each stage calls one operator on all that the stage before kept; its result is written as
Parquet and read again as the next one's documents. All stages but the last return the
columns of documents.
"""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession

from fieldbook.llm import decontam, linededup, packing, simhash, toxicity
from fieldbook.llm.common import table
from fieldbook.session import materialise


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has go; the documents stay."""
    return linededup.drop_repeated_lines(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.drop_near_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens, each with its sequence, its place there and its ids."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), keep_ids=True)


STAGES = [
    ("toxicity", clean_of_toxicity),
    ("line dedup", without_repeated_lines),
    ("simhash near-dedup", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("best-fit packing", packed),
]

#: Learning the toxicity model and encoding texts are beyond SQL; tests hold the pipeline
#: against a plain version in Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

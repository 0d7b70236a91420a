"""The operators' queries, each over its whole table with production parameters."""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.llm import (
    decontam, language, licenses, linededup, maintext, negatives, packing, periods, quality, rules, simhash, tokenfiles, toxicity,
)
from fieldbook.llm.common import REGISTRY, query, table


__all__ = ["REGISTRY"]


@query("op1_quality_classifier")
def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op2_language_mixture")
def language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return language.languages(table(spark, folder, "documents")).drop("mixture")


@query("op3_token_files")
def token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokenfiles.token_round_trip(spark, table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query("op4_line_dedup", linededup.SQL)
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = linededup.dedup_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_benchmark_decontamination", decontam.SQL)
def benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.hits(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op6_quality_rules", rules.SQL)
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.clean(table(spark, folder, "documents"), with_text=False)


@query("op7_license_scan", licenses.sql())
def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.licenses(table(spark, folder, "documents")).drop("spans")


@query("op8_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


@query("op9_toxicity")
def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op10_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_groups(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query("op11_periodic_runs")
def periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periods.run_digests(table(spark, folder, "documents"), planted=True)


@query("op12_main_text")
def main_text(spark: SparkSession, folder: str) -> DataFrame:
    return maintext.main_texts(table(spark, folder, "pages"))


@query("op13_hard_negatives", negatives.SQL)
def hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("vec_id")
    label = F.when(number % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, folder, "embeddings").withColumn("label", label), anchors=number % 50 == 0)

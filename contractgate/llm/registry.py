"""Registered queries of this subpackage: one per operator, and the pipeline."""

from __future__ import annotations

import public_tokenizers as tokenizers_of
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from . import (
    collocations, exact_dedup, lexical_search, line_dedup, mixing, near_dup, nearest, packing, secret_scan, subword_classifier,
    token_count, token_files, toxicity,
)
from .common import crc_fold, ship, table


# Fixed settings of the mixture: which source belongs to which domain, and the weights (others: 1).
DOMAIN = "CASE WHEN source = 'src0' THEN 'web' WHEN length(source) = 4 THEN 'books' ELSE 'forums' END"
MIX = {"weights": {"domain": {"web": 5, "books": 3, "forums": 2}, "lang": {"en": 6, "de": 2}},
       "percent": 60, "max_epochs": 4, "seed": 20}


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_progressive_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), digest_all=True)


def op3_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op8_hierarchical_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), F.expr(DOMAIN), **MIX)
    return mixed.select("doc_id", *[F.col(f"mix_{n}").alias(n) for n in mixing.LEVELS],
                        mixing.word_count().alias("tokens"), F.col("mix_copies").alias("copies"))


def op9_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(table(spark, sf_dir, "documents"))


def _judged(scored: DataFrame, held_out: Column) -> DataFrame:
    return scored.select(F.col("doc_id"), held_out.alias("held_out"), F.col("score"),
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op4_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), crc_fold("doc_id", 3) == 1
    model = subword_classifier.fit(docs, table(spark, sf_dir, "labels"), "quality", keep=~held_out)
    return _judged(subword_classifier.score(docs.select("doc_id", "text"), model), held_out)


def op5_pattern_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), crc_fold("doc_id", 5) == 0
    grammar = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic", keep=~held_out)
    return _judged(toxicity.score(docs.select("doc_id", "text"), grammar), held_out)


def op6_simhash_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "lines_in", "lines_dropped", F.sha2("text", 256).alias("text_sha256"), "text")


def packed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    ship(spark)
    out = packing.best_fit_pack(
        docs, tokenizers_of.path("byte_bpe_50k.json"), capacity=1024, end_id=2,
        ranks=tokenizers_of.path("byte_bpe_50k.tiktoken"), pattern=tokenizers_of.PATTERN, keep_ids=False)
    return out.drop("ids")


def op7_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(spark, table(spark, sf_dir, "documents"))


def op10_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), tokenizers_of.path("piece_bpe_32k.model"), limit=4096)


def op11_itemset_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.phrases(table(spark, sf_dir, "documents"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "llm/token-files", fresh=True)
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, tokenizers_of.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_token_files(spark, folder).drop("ids")


def op13_interval_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES = {f.__name__: f for f in (
    op1_order_minhash, op2_progressive_dedup, op3_cross_polytope, op4_subword_quality, op5_pattern_toxicity, op6_simhash_lines,
    op7_best_two_fit, op8_hierarchical_mix, op9_entropy_secrets, op10_piece_counts, op11_itemset_phrases, op12_token_files,
    op13_interval_search)}

ORACLE_SQL: dict[str, str] = {
    "op2_progressive_dedup": exact_dedup.ORACLE,
    "op8_hierarchical_mix": mixing.oracle(DOMAIN, **MIX),
    "op11_itemset_phrases": collocations.ORACLE,
    "op13_interval_search": lexical_search.ORACLE,
}

"""The numbered queries: thin digests of the operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm import fim, hashtree, hpylm, langid, lexsearch, mil, minhash, mixing, packing, pages, quality_rules, simhash, substring
from gridmart.llm.common import prepare, table

SHARDS = 40


def op1_attention_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = mil.score(docs, mil.train(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scored.select("doc_id", mil.held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op3_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


def op4_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup(table(spark, sf_dir, "documents"), window=20)


def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hpylm.score(table(spark, sf_dir, "documents"))


def op6_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaves = hashtree.topology(SHARDS)
    out = hashtree.shard(table(spark, sf_dir, "documents"), leaves, hashtree.grow(leaves))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.apply_rules(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_stop_words", "n_marks",
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.plan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.compare_edits(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(prepare(spark), sf_dir, "documents"))


def op11_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.identify(docs, langid.train(docs))
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.transform(table(spark, sf_dir, "documents"))
    restored = fim.restore(F.col("output"), F.col("form"))
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256")]
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexsearch.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_attention_mil": op1_attention_mil,
    "op2_simhash": op2_simhash,
    "op3_page_differencing": op3_page_differencing,
    "op4_difference_cover": op4_difference_cover,
    "op5_pitman_yor": op5_pitman_yor,
    "op6_hash_tree": op6_hash_tree,
    "op7_quality_rules": op7_quality_rules,
    "op8_mixing": op8_mixing,
    "op9_minhash": op9_minhash,
    "op10_packing": op10_packing,
    "op11_kneser_ney": op11_kneser_ney,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_norm_buckets": op13_norm_buckets,
}

"""The corpus pipeline: quality rules, SimHash near-dedup, substring dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. Null ids, null
or empty texts, repeated rows and empty tables have the results that the operators' docstrings state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridmart.llm import mixing, packing, quality_rules, simhash, substring
from gridmart.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality_rules.keep_clean(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: four-word shingles, four bits."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of 20-word windows that occur earlier in the corpus go; every row stays."""
    return substring.strip(docs, window=20)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its token ids, its sequence and offset."""
    return packing.pack(docs, keep_ids=True)


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", simhash_stage),
    ("substring_dedup", substring_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again before the next stage."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs


#: DuckDB has neither the tokeniser nor XXH64: the stages are tested against brute-force versions instead.
ORACLE_SQL = None

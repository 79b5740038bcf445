"""Corpus preparation: quality rules, near-dedup, line dedup, benchmark
decontamination and packing, each stage written as Parquet and read again as
the next one's documents.

A stage is a function (spark, docs, sf_dir) -> DataFrame. All but the last
return the columns of ``documents``, whatever further columns and names these
have; the last returns packed pieces.

Defined cases: the quality rules reject null and empty texts, so later stages
see neither unless a stage empties a text (its row stays). Among near copies
the least doc_id stays; rows of a null id are groups of their own there and stay,
and rank before all others in line dedup. Repeated rows (equal id and text) share every
verdict and all stay. Texts of any length are taken whole. Empty tables give
empty stages; an empty benchmark cuts nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rangewise.llm import decontaminate, minhash, packing, quality_rules, substring_dedup
from rangewise.llm.common import documents, fresh, written


def rule_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the least id."""
    kept_id = fresh(docs, "kept_id")
    kept = minhash.near_duplicates(docs).where("kept").select(F.col("doc_id").alias(kept_id))
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col(kept_id)), "left_semi")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document or place has go."""
    return substring_dedup.deduped(docs)


def benchmark_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of benchmark items are cut out."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.cleaned(docs, benchmark)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, placed in sequences."""
    return packing.pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", rule_filter),
    ("minhash_near_dedup", near_dedup),
    ("substring_dedup", line_dedup),
    ("decontamination", benchmark_spans),
    ("best_fit_packing", packed),
]

#: MinHash and the tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    out = documents(spark, sf_dir)
    for name, stage in STAGES:
        out = stage(spark, out, sf_dir)
        if name != STAGES[-1][0]:
            out = written(spark, out, name)
    return out

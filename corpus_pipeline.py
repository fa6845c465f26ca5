"""The corpus pipeline: from raw documents to packed training sequences.

The order is fixed: rejects first, since cheap decisions shrink what later stages shuffle; exact copies before near
ones, so that a hot text has one fingerprint to compare; mixing last among the choices, as weights hold for what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tramline.llm import exact_dedup, mixing, near_dedup, packing, quality
from tramline.llm.common import materialise, table


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality.stage),
    ("exact_dedup", exact_dedup.stage),
    ("near_dedup", near_dedup.stage),
    ("source_mixing", mixing.stage),
    ("best_fit_packing", pack),
]

# The classifier and the packing solve numerical problems that SQL can't express; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

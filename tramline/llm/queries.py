"""The queries opN_<name> over whole tables, with the production parameters that the operators have by default."""

from __future__ import annotations

from . import exact_dedup, line_dedup, mixing, near_dedup, packing, quality, sharding, substring_dedup, url_filter, vector_dedup
from .common import table
from .sql import ORACLES

QUERIES = {
    "op1_best_fit_packing": lambda s, d: packing.pack(table(s, d, "documents")),
    "op2_url_filter": lambda s, d: url_filter.url_filter(table(s, d, "pages")),
    "op3_substring_dedup": lambda s, d: substring_dedup.substring_dedup(table(s, d, "documents")),
    "op4_line_dedup": lambda s, d: line_dedup.line_dedup(table(s, d, "documents")),
    "op5_sharding": lambda s, d: sharding.shard(table(s, d, "documents")),
    "op6_near_dedup": lambda s, d: near_dedup.near_dedup(table(s, d, "documents")),
    "op7_quality_classifier": lambda s, d: quality.classify(table(s, d, "documents"), table(s, d, "labels")),
    "op8_source_mixing": lambda s, d: mixing.mix_sources(table(s, d, "documents")),
    "op9_exact_dedup": lambda s, d: exact_dedup.exact_dedup(table(s, d, "documents"), table(s, d, "labels")),
    "op10_vector_dedup": lambda s, d: vector_dedup.vector_dedup(table(s, d, "embeddings")),
}

__all__ = ["ORACLES", "QUERIES"]

"""All registered queries of the corpus operators."""

from tidemark.llm import decontamination, embedding_dedup, license_scan, merkle_manifest, ngram_join, packing, periodic_runs, pii, sharding, substring_dedup, token_files, toxicity, vector_search  # noqa: F401
from tidemark.llm.registry import LLM_QUERIES, LLM_SQL

__all__ = ["LLM_QUERIES", "LLM_SQL"]

"""All queries of this subpackage; importing it registers them."""

from __future__ import annotations

from . import exact_dedup, jaccard_join, langid, packing, quality, sentencepiece_fst, suffix_sort, suffix_trees, threshold_mining, token_files, topk, url_filter, whitening  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

"""Pipeline stages, each a DataFrame -> DataFrame step."""

from .blocking import block_stats, candidate_pairs
from .clusters import best_match_probability, dense_ids
from .components import connected_components
from .scoring import compare_pairs, link_pairs, score_pairs

__all__ = [
    "best_match_probability",
    "block_stats",
    "candidate_pairs",
    "compare_pairs",
    "connected_components",
    "dense_ids",
    "link_pairs",
    "score_pairs",
]

"""reunion: probabilistic entity resolution on Spark DataFrames."""

from .constants import DEFAULT_PRIOR, DEFAULT_THRESHOLD
from .errors import MatchError
from .model import Comparison, Model
from .plans.resolve import resolve, resolved_view

__all__ = ["DEFAULT_PRIOR", "DEFAULT_THRESHOLD", "Comparison", "MatchError", "Model", "resolve", "resolved_view"]

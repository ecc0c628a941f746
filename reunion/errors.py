"""User-facing errors."""

from __future__ import annotations


class MatchError(ValueError):
    """An input problem the caller can fix: empty relation, bad threshold, missing columns."""

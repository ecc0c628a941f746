"""Whole-relation plans built from the stages."""

from .resolve import parse_columns, resolve, resolved_view

__all__ = ["parse_columns", "resolve", "resolved_view"]

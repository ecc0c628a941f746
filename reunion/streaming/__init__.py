"""Structured Streaming entry points."""

from .score import score_stream, score_stream_to

__all__ = ["score_stream", "score_stream_to"]

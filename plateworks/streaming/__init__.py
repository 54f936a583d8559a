"""The scoring operators on streams."""

from .scoring import potential_stream, score_stream, windowed_counts  # noqa: F401

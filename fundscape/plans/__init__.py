"""Registered queries; importing the package registers all."""

from . import macro_queries, panel_queries, quality_queries, relational_queries, scoring_queries, streaming_queries, text_queries  # noqa: F401

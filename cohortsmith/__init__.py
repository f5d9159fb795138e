"""cohortsmith: index-date cohort and feature building on Spark DataFrames."""

from .session import build_session, ensure_store

__all__ = ["build_session", "ensure_store"]

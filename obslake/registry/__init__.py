"""Named queries over the given tables, each with its SQL counterpart where SQL can say it."""

from __future__ import annotations

from obslake.registry import columns, derived, jobs, lake, models, observations, series
from obslake.registry.base import QUERIES

__all__ = ["QUERIES", "columns", "derived", "jobs", "lake", "models", "observations", "series"]

"""Spark ML repeat-buyer models and their metrics."""

from . import metrics, models

__all__ = ["metrics", "models"]

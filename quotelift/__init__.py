"""Snapshot-based propensity scoring and ranking, written as Spark DataFrame code."""

__version__ = "0.1.0"

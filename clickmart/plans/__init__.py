"""Whole queries: the named catalog and its DuckDB oracle."""

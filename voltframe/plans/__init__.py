"""Composite jobs and the query catalogue (with its DuckDB oracle)."""

"""Derived input views, the query catalogue and its DuckDB oracle SQL."""

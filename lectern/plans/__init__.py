"""Registered queries (Spark callables + DuckDB oracle SQL) and end-to-end jobs."""

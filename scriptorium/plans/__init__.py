"""Composed jobs, the registered queries and their DuckDB oracle SQL."""

"""Compositions: the registered queries, their DuckDB oracle, and the four batch jobs."""

"""Inputs and outputs: access-log text, parquet tables, plan cuts, test fixtures derived from the driver tables."""

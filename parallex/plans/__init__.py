"""Registered queries over the driver tables and their DuckDB oracles."""

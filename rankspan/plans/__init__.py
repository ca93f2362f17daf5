"""Registered workloads and their DuckDB oracle statements."""

"""Registered driver queries, their DuckDB oracles and the deterministic stub client."""

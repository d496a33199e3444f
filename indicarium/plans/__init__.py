"""Indicator pipelines, incremental load, run audit and registered queries."""

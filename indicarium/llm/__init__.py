"""Operators of a training-data pipeline, one module each, re-expressed as Spark jobs.

Nothing else in the library imports this subpackage.
"""

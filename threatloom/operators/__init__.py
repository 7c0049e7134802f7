"""Operators: functions from DataFrames to DataFrames. Only ``writes`` and ``lineage`` have side effects."""

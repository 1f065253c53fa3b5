"""Evaluation-evidence analytics as plain Spark jobs.

Every operator takes DataFrames that hold many runs at once and returns a
DataFrame; nothing is collected, and no Python code runs per row.
"""

"""Equity-panel analytics as plain Spark DataFrame functions.

A panel is a DataFrame with one row per (``date``, ``ticker``).  Every operator
takes DataFrames and returns a DataFrame; nothing is collected on the driver
except schemas and tables whose size is bounded by the number of calendar days.
"""

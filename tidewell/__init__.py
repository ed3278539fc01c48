"""Tidewell: analytics jobs on tables, text and small graphs, written for Spark.

Operators take DataFrames and return DataFrames.  They never depend on how the
input happens to be partitioned.
"""

__version__ = "0.1.0"

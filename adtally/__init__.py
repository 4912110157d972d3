"""Advertising-performance and deposit analytics on Spark DataFrames.

Every operator takes DataFrames and returns a lazy DataFrame built from Spark's
own expressions.  See README.md for the map from report to module.
"""

__version__ = "0.1.0"

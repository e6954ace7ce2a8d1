"""Incremental JSON records -> typed tables -> change history -> daily facts, on Spark.

Every operator takes DataFrames and column names and returns a DataFrame.
Nothing here keeps global state; the session is the caller's.
"""

__version__ = "0.1.0"

"""Sluice: content ingestion, state tracking and text-corpus preparation on PySpark.

Every operator is a function from DataFrames (or Columns) to a DataFrame (or
Column).  Run time stamps and run ids are parameters; nothing in a transform
reads the clock.
"""

__version__ = "0.1.0"

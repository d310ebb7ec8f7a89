"""cohortmill: event tables to segmented entity profiles, on Spark DataFrames."""

__version__ = "0.1.0"

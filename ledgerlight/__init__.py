"""Adoption, usage and cost analytics over platform logs, as Spark DataFrames.

Everything is a function from DataFrames to a DataFrame.  ``operators`` holds the
reusable transforms, ``plans`` puts them together into facts and reports,
``sources`` reads and writes tables and flattens landed documents, ``streaming``
keeps facts up to date, and ``functions`` holds column expressions.
"""

__version__ = "0.1.0"

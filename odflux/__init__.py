"""Origin-destination flow series on PySpark.

Every operator takes and returns lazy DataFrames built from column
expressions; ``DataFrame.transform`` is the composition tool.
"""

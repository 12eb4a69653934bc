"""Data-pipeline operators and ready-to-run pipelines for PySpark.

Every operator is a plain function from DataFrames to a DataFrame. Paths, times
and "now" are parameters; no module keeps a session of its own.
"""

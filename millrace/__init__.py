"""A two-layer retail warehouse built with PySpark DataFrames."""

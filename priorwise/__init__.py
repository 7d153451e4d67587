"""Point-in-time analytics over star schemas with event history, on Spark DataFrames."""

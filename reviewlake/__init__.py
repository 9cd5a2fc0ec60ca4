"""Customer-review analytics on Spark DataFrames."""

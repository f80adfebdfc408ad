"""Stock-origin analytics on Spark DataFrames."""

"""Usage-record analytics on Spark DataFrames."""

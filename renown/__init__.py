"""Public-attention analytics on Spark DataFrames."""

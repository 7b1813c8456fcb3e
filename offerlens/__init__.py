"""Campaign-response analytics on Spark DataFrames."""

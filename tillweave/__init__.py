"""Weekly sales panel analytics on Spark DataFrames."""

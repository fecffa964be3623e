"""millrace: medallion-style analytics on Spark DataFrames."""

"""Manufacturing-quality analytics on Spark DataFrames."""

"""Question-and-answer forum analytics on Spark DataFrames."""

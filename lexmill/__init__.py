"""lexmill: document structuring and corpus operators on Spark DataFrames."""

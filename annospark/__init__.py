"""Annotation indexing and corpus preparation on Spark DataFrames."""

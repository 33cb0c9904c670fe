"""Methylation and genomic-interval analytics on Spark DataFrames."""

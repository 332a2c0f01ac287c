"""Retail-basket analytics on Spark DataFrames."""

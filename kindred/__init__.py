"""Kindred: record linkage and corpus processing on Spark DataFrames."""

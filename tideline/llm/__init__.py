"""Operators of a training-data pipeline, each a method of its own on Spark DataFrames."""

"""Wafer-test analytics on Spark DataFrames."""

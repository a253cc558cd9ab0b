"""Longitudinal registry data on Spark DataFrames."""

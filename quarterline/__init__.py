"""Firm-quarter panel analytics on Spark DataFrames."""

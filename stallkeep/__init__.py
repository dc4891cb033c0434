"""Retail warehouse, conformance and data-quality engine on Spark DataFrames."""

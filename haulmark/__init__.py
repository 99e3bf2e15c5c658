"""Inbound freight cost and supplier performance on Spark DataFrames."""

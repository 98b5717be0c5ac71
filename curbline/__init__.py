"""Curbline: monthly trip records to a trustworthy daily zone table, on Spark."""

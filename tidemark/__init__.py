"""Tidemark: churn analytics over monthly customer panels, on Spark DataFrames."""

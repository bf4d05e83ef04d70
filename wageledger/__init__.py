"""Compensation-ledger analytics on Spark DataFrames."""

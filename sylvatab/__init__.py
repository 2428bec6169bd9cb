"""Cleaning and combining species measurement tables on Spark DataFrames."""

"""Lands delimited drops into typed tables and builds named views over them, on Spark DataFrames."""

"""Tidy, allocate, project and price material-intensity tables on Spark DataFrames."""

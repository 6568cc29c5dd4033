"""Gridded time series ("datacube") analytics on Spark DataFrames."""

"""geoloom: geospatial analytics on Spark DataFrames."""

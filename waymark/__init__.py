"""waymark: place and catalog data processing on Spark DataFrames."""

"""strata: layered trip analytics on Spark DataFrames."""

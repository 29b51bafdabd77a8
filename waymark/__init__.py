"""waymark: linear-referenced road-network analytics on Spark DataFrames."""

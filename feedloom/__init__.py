"""Feed-ranking data engine on Spark DataFrames."""

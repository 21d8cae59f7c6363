"""Table-driven record mapping on Spark DataFrames."""

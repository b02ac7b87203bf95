"""Record linkage, point-in-time features and exact evaluation on Spark DataFrames."""

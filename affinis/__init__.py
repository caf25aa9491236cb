"""Record linkage across noisy business sources on Spark DataFrames."""

"""News-topic coverage analytics on Spark DataFrames."""

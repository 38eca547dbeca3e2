"""Health-cost analytics on Spark: operators from DataFrames to DataFrames."""

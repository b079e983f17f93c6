"""Market-data analytics on Spark: DataFrame and Structured Streaming operators."""

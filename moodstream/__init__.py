"""Comment-sentiment analytics on Spark: clean, classify and summarise short texts."""

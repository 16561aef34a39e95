"""Market-sales analytics on Spark."""

"""Where data comes from and goes to: bronze JSON, partitioned parquet, serving tables."""

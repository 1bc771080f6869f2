"""Table maintenance on parquet tables of the session catalog."""

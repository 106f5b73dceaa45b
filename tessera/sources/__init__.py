"""Files coming in and tables kept in Parquet."""

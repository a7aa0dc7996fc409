"""Reading delimited files and the Parquet tables."""

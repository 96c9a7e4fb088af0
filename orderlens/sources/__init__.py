"""Sources: test-table fixtures, Parquet lake scans and topic readers."""

"""Sources: parquet tables, declared schemas, role frames from the test tables."""

"""Reading and writing: CSV with quarantine, Parquet tables, JSON documents."""

"""Reading and writing tables: Parquet and CSV stand in for geographic files."""

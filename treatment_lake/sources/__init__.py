"""Sources: driver tables, the adapter, item JSON, Parquet layers, file metadata."""

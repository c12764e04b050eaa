"""Reading and writing: landing CSV, JSON documents, Parquet layers, the warehouse."""

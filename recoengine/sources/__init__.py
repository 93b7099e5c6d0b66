"""Connectors: delimited text loaders, typed Parquet tables, keyed sinks."""

"""Readers: Parquet tables, JSON lines, delimited labels, logs and dumps."""

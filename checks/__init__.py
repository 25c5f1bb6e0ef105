"""Registered queries over the shared parquet tables, and their SQL twins."""

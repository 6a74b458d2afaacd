"""Typed CSV and parquet readers and writers."""

"""Readers for CSV, JSON archives, word lists, parquet tables and message streams."""

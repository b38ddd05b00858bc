"""Readers and writers: dated CSV extracts and Parquet tables."""

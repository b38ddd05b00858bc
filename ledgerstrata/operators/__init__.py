"""Ledger operators: pure functions from DataFrames to DataFrames."""

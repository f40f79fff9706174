"""Typed CSV scans, the Parquet mart store and the scratch area."""

"""Scans: JSON, CSV, Parquet, preferred-with-fallback, listings, aggregate slices."""

"""Sinks: Parquet/CSV/JSON writers, preview, and the day-sliced landing tables."""

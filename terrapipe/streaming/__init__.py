"""Structured Streaming entry point for the daily load (no streaming
operators exist in the reference; this only re-expresses its daily trigger)."""

"""Composed jobs: fixtures from the driver tables, the daily run, the query catalogue."""

"""Spark-native engine for daily territorial reference data.

Nested state and municipality batches are gated, flattened, cleaned,
de-duplicated, landed one day-slice at a time and explored, all as
DataFrame plans (see README.md for the module map).
"""

__version__ = "0.1.0"

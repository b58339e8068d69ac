"""Relational operators: dedup, hierarchy transforms, quality gates, analytics."""

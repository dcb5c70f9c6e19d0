"""Composed reads, operational queries and the registered query catalogue."""

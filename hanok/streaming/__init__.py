"""Incremental streams over the landing zone."""

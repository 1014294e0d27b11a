"""Relational building blocks: every function takes and returns DataFrames."""

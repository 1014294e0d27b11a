"""Readers: landed files, API answers and small documents."""

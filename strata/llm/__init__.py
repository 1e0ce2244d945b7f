"""Operators of a training-data pipeline over the corpus tables.

Nothing else in the library imports this package. Each module is one operator
with its own interface; ``queries`` holds the thin registered queries.
"""

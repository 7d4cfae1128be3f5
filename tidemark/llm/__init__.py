"""Operators of a training-data pipeline: mixing, near-duplicates, search, scoring, archives, text.

Nothing else in the library imports this package; it may import the library's general helpers.
"""

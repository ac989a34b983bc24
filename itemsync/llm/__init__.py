"""Operators of a training-data pipeline: scoring, deduplication, scans, formatting, archives, mixing.

Nothing else in the library imports this package.
"""

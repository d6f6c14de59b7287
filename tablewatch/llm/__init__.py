"""Operators of a training-data pipeline: quality rules, scoring, extraction,
mixing, formatting, tokenising and near-duplicate removal.

Each module holds one operator with its own interface; ``queries`` applies
them to the given tables.  Nothing else in the library imports this package.
"""

"""Operators for training-data pipelines, each in its own module, with their queries.

Every module states its rules for nulls, empty texts, ties, repeated rows and clashing columns.
"""

"""Operators for training-data pipelines: documents, benchmark items, conversations, vectors.

Nothing else in the library imports this subpackage.
"""

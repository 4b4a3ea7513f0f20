"""Operators of a training-data pipeline over documents, embeddings and web pages.

Nothing else in the library imports this subpackage.
"""

"""Operators of a training-data pipeline over documents, conversations and embeddings.

Nothing outside this folder imports it. Queries are in ``queries``.
"""

"""Operators of a training-data pipeline: numbered operators over documents and embeddings.

Every module holds one operator with its general interface; ``queries``
holds the thin registered queries and ``oracle`` their SQL.  Nothing else in
the library imports this sub-package.
"""

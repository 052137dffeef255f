"""Operators of a training-data pipeline over documents, pages and embeddings.

Nothing else in the library imports this subpackage.  ``queries`` holds the
registered ``opN_*`` queries; every other module is one operator with its own
general interface.
"""

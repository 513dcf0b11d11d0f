"""Operators for a training-data pipeline over a table of documents.

Nothing else in the package imports this folder.  ``queries.py`` holds the
registered queries; every other module is an operator or a helper of one.
"""

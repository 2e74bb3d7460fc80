"""Operators for building training corpora from documents, pages and vectors.

Nothing else in the library imports this subpackage. Each module holds one
operator; ``queries`` applies them to the standard tables.
"""

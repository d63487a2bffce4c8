"""Operators for preparing language-model training data.

Each module is one operator with a general DataFrame interface; ``queries`` holds
the thin registered queries. Nothing else in the library imports this package.
"""

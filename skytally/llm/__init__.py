"""Operators for text corpora: tokenizers, quality, duplicates, archives, models.

Nothing else in the library imports this package.  Each module is one operator
with its own interface; ``queries`` applies them to the given tables.
"""

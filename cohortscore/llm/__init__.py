"""Operators that prepare text corpora for training language models.

Nothing else in the library imports this subpackage. Each module holds one
operator, ``queries`` registers them over the benchmark tables.
"""

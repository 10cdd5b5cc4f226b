"""Operators for large training-text corpora.

Each module holds one operator with its general interface; ``queries.py``
wraps them as the registered ``opN_<name>`` queries.
"""

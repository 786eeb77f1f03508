"""Operators for large training-text collections.

Each module holds one operator with its own general interface; ``queries`` applies them to
the test tables.  Nothing outside this package imports it.
"""

"""Operators that prepare training data for language models.

Nothing outside this package imports it; it may be deleted without effect on
the rest of the library.
"""

"""Operators for preparing training data: cleaning, deduplication, mixing, tokens.

Nothing outside this package imports it.  Every operator takes DataFrames of
the caller's session and returns DataFrames.
"""

"""Readers and writers."""

from nextbest.sources.tables import read_table  # noqa: F401

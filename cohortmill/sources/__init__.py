"""Readers.  All return plain DataFrames."""

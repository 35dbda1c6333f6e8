"""Batch operators: every one is a DataFrame -> DataFrame function."""

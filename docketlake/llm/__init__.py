"""Operators that prepare text and records for training data.

Nothing outside this package imports it: ``__spark_entry__`` adds its queries
only where it can be imported.
"""

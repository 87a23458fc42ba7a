"""Docketlake: document-evidence analytics on Spark DataFrames.

Operators take DataFrames and return DataFrames; nothing here holds a session
or collects a relation.  See README.md for the catalogue.
"""

__version__ = "0.1.0"

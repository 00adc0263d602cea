"""Relational normalisation on Spark: clean, flatten, key, enrich, load and check tables."""

__version__ = "0.1.0"

"""Span extraction and multi-label classification over long documents, on Spark DataFrames."""

__version__ = "0.1.0"

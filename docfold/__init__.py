"""Fold keyed change logs into flat document tables and search them, on Spark."""

from docfold.options import FoldOptions

__all__ = ["FoldOptions"]

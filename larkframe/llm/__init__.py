"""Operators for training-data pipelines over documents, vectors and pages. Nothing else in the library imports this."""

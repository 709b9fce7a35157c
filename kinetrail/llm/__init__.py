"""Operators for training-data pipelines over text; nothing else in the package imports this folder."""
